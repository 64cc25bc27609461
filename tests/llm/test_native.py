"""Operators made of DataFrame functions only: chat formatting, URL filter, mixing."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F
import pytest

from staykit.llm import chat, mixing, urls
from staykit.sources.tables import Workspace


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


def without_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# Chat


def test_chats_round_trip(spark):
    random.seed(6)
    pieces = ["<|im_end|>", "\n", "<|im_start|>", "<\\|", "<", "|", "\\", "%0A", "%25", "$1", "a", "assistant", " ", "é"]
    rows = [
        (c, t, random.choice(["user", "assistant", "", None, "a\nb", "x<|im_end|>\ny", "%7C"]),
         random.choice([None, "".join(random.choices(pieces, k=random.randint(0, 12)))]))
        for c in range(80) for t in range(random.randint(1, 6))
    ]
    rows += [(100, 1, "user", "same"), (100, 1, "user", "same"), (100, None, "user", "first"), (None, 0, "assistant", "z" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    chats = chat.format_chats(df)
    assert without_python(chats)
    found = {r.conv_id: r for r in chats.withColumn("turns", chat.parse(F.col("formatted"))).collect()}
    assert len(found) == len({r[0] for r in rows}) and all(r.identical for r in found.values())
    cut = chats.select("conv_id", chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("said"))
    assert without_python(cut)
    cut = {r.conv_id: r.said for r in cut.collect()}
    for key, r in found.items():
        turns = sorted(
            ((-(2**63) if t is None else t, role or "", text or "") for c, t, role, text in rows if c == key),
        )
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        masked = [r.formatted[s.begin:s.end] for s in r.loss_spans]
        said = [text for _, role, text in turns if role == "assistant"]
        assert len(masked) == len(said)
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in masked] == said
        assert cut[key] == said
    assert chat.format_chats(df.limit(0)).count() == 0


def test_plain_chats_are_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b | c"), (1, 1, "assistant", "\\ok")], "conv_id long, turn long, role string, text string")
    r = chat.format_chats(df).first()
    assert r.formatted == "<|im_start|>user\na < b | c<|im_end|>\n<|im_start|>assistant\n\\ok<|im_end|>\n" and r.escaped_turns == 0


def test_parser_rejects_what_is_no_chat(spark):
    broken = ["no marks", "<|im_start|>user", "<|im_start|>user\nx<|im_end|>\ntail", "<|im_start|>a\n<|im_start|>b\nx<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in broken], "t string").select(chat.parse(F.col("t")).alias("turns"))
    assert all(any(t.role is None for t in r.turns) for r in df.collect())


# URLs

RULES = [urls.Rule("block", "net"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("allow", "net", "/e"), urls.Rule("block", "a.b")]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.name), len(r.host)), default=None)
    return host, path, best


def test_urls_equal_brute_force(spark, work):
    random.seed(8)
    hosts = ["net", "Example.NET", "x.example.net", "notexample.net", "a.b", "c.a.b", "a.bc", "spam.org", "", "É.net", "net."]
    made = [
        f"{random.choice(['http', 'x', ''])}://{random.choice(hosts)}{random.choice(['', '/', '/en/', '/e', '/en', '/x/y'])}{random.choice(['', '?q=/en/', '#t', '?a://b'])}"
        for _ in range(300)
    ]
    listed = [None, "", "abc", "://", "http:/net/", "http://a b/\nc", "http://" + "a." * 2000 + "net/", *made, *made[:50]]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(listed)], "page_id long, url string, verdict string")
    judged = urls.filter_urls(pages, RULES, F.col("host") == "spam.org", work)
    assert without_python(judged) and "Join" not in judged._jdf.queryExecution().executedPlan().toString()
    found = {r.page_id: r for r in judged.collect()}
    assert len(found) == len(listed)
    for i, u in enumerate(listed):
        host, path, rule = brute_rule(u)
        verdict = rule.action if rule else "block" if host == "spam.org" else "allow"
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, rule and rule.name, verdict), u
    assert urls.filter_urls(pages.limit(0), RULES, F.lit(False), work).count() == 0
    assert urls.filter_urls(pages, [], F.lit(None), work).where("verdict <> 'allow'").count() == 0


def test_cascade_is_exact_over_its_universe(spark, work):
    for listed in (0, 1, 700, 2000):
        universe = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.xxhash64("id") % 2000 < 0).alias("_"), (F.col("id") < listed).alias("listed"))
        cascade = urls.build_cascade(universe.select("key", "listed"), work)
        wrong = cascade.with_filters(universe).where(cascade.contains(F.col("key")) != F.col("listed"))
        assert wrong.count() == 0
        assert listed in (0, 1, 2000) or len(cascade.levels) > 2


# Mixing


def numpy_raking(cells, targets, rounds):
    """The textbook algorithm on a dictionary of cells."""
    weights, total = {k: float(t) for k, t in cells.items()}, float(sum(cells.values()))
    for _ in range(rounds):
        for axis, wanted in enumerate(targets):
            sums = {}
            for k, w in weights.items():
                sums[k[axis]] = sums.get(k[axis], 0.0) + w
            weights = {k: w * (wanted[k[axis]] * total / sums[k[axis]] if sums[k[axis]] else 0.0) for k, w in weights.items()}
    return weights


def test_raking_equals_brute_force(spark, work):
    random.seed(9)
    cells = {(s, g, t): random.randint(1, 500) for s in "abc" for g in "xy" for t in "pqr"}
    targets = [{"a": 0.2, "b": 0.5, "c": 0.3}, {"x": 0.6, "y": 0.4}, {"p": 0.1, "q": 0.1, "r": 0.8}]
    frame = spark.createDataFrame([(*k, n) for k, n in cells.items()], "source string, lang string, topic string, tokens long")
    tables = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in zip(mixing.MARGINS, targets)}
    tables["source"] = tables["source"].unionByName(spark.createDataFrame([("absent", 0.0)], "source string, target double"))
    mixture = mixing.rake(frame, tables, work)
    expected = numpy_raking(cells, targets, mixture.rounds)
    found = {(r.source, r.lang, r.topic): r.weight for r in mixture.cells.collect()}
    assert found.keys() == expected.keys() and all(np.isclose(found[k], expected[k], rtol=1e-9) for k in expected)
    assert mixture.error <= 1e-6 and np.isclose(sum(found.values()), sum(cells.values()))


def test_mix_meets_targets_and_is_repeatable(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    mixed, mixture = mixing.mix(docs, work)
    assert without_python(mixed) and mixture.error <= 1e-6
    mixed = work.store(mixed)
    assert mixed.count() == docs.count()
    tokens, expected, taken = mixed.selectExpr("sum(n_tokens)", "sum(n_tokens * rate)", "sum(n_tokens * copies)").first()
    assert abs(expected / tokens - 0.5) < 1e-9 and abs(taken / tokens - 0.5) < 0.05
    shares = mixed.groupBy("lang").agg(F.sum("n_tokens").alias("n"), F.sum(F.col("n_tokens") * F.col("rate")).alias("w")).collect()
    powers = {r.lang: r.n**mixing.TEMPERATURE for r in shares}
    assert all(abs(r.w / expected - powers[r.lang] / sum(powers.values())) < 1e-5 for r in shares)
    again, _ = mixing.mix(docs.repartition(5), work)
    assert again.join(mixed.select("doc_id", F.col("copies").alias("before")), "doc_id").where("copies <> before").count() == 0


def test_mix_odd_rows(spark, work):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b", None, "s"), (3, "a b", None, "s"), (None, "c d e", "fr", None), (5, "x " * 50_000, "en", "hot")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, weight int")
    mixed, _ = mixing.mix(docs, work, kept=1.0)
    found = mixed.collect()
    assert len(found) == len(rows) and all(r.copies >= 0 and r.rate >= 0 for r in found)
    assert all(r.rate == 0 and r.copies == 0 for r in found if r.n_tokens == 0)
    assert len({r.copies for r in found if r.doc_id == 3}) == 1
    assert mixing.mix(docs.limit(0), work)[0].count() == 0
