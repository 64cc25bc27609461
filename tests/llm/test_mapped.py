"""Operators that map documents: token counts, language, toxicity, quality, decontamination."""

from __future__ import annotations

from collections import Counter
import math
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from staykit.llm import decontaminate, language, quality, tokens, toxicity
from staykit.llm.queries import vocabulary_path
from staykit.sources.tables import Workspace

DOCS = "doc_id long, text string, lang string, source string"
SF = "/root/testdata/sf0.01"


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


def odd_texts():
    """NULLs, empty and long texts, ties and repeated rows."""
    return [None, "", " ", "\n\n", "a", "one two", "one two", "1 2 3", "!?", "é" * 3, "word " * 30_000, "x" * 50_000]


# Token counts


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    random.seed(2)
    letters = "ab 's'tT\n\r\t é<|endoftext|>1２ 中 .!  \x1c\x85'll"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(400)]
    texts += ["a<|endoftext|>b", "<|endoftext|>" * 3, *odd_texts()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, vocabulary_path()).collect()}
    for i, t in enumerate(texts):
        expected = len(library.encode(t or "", add_special_tokens=False).ids)
        assert found[i] == (len((t or "").encode()), expected, expected > 1024), repr(t)[:80]


def test_token_counts_of_all_documents(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = tokens.count_tokens(docs, vocabulary_path()).collect()
    assert len(found) == len(texts)
    assert all(r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in found)
    assert tokens.count_tokens(docs.limit(0), vocabulary_path()).count() == 0


# Language


def test_language_of_held_out_documents(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    found = language.identify(docs.drop("source"), language.fit_languages(docs.where(~held_out), work)).where(held_out)
    right, total, low, high = found.agg(
        F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1)), F.min("score"), F.max("score")
    ).first()
    assert right / total > 0.99 and 0 <= low <= high <= 1


def test_language_words_first_then_shorter_groups(spark, work):
    docs = spark.createDataFrame(
        [(1, "katze hund katze", "de", "s"), (2, "chat chien chat", "fr", "s"), (3, "zzz", None, "s")], DOCS
    )
    model = language.fit_languages(docs, work)
    assert model.languages == ["de", "fr"]
    best = lambda w: model.languages[model.word_scores(w).argmax()]
    assert best("katze") == "de" and best("chat") == "fr"  # known words
    assert best("katzen") == "de" and best("chiens") == "fr"  # by letter groups
    assert (model.word_scores("ж") == model.word_scores("ж").max()).all()  # nothing known


def test_language_odd_rows(spark, work):
    docs = spark.createDataFrame([(1, "katze hund", "de", "s"), (2, "chat chien", "fr", "s")], DOCS)
    odd = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd_texts())], "doc_id long, text string, score int")
    found = {r.doc_id: r for r in language.identify(odd, language.fit_languages(docs, work)).collect()}
    assert len(found) == len(odd_texts())
    for i, t in enumerate(odd_texts()):
        lettered = any(c.isalpha() for c in t or "")
        assert (found[i].lang_pred == "und") != lettered and 0 <= found[i].score <= 1
    empty = language.fit_languages(docs.limit(0), work)
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.identify(odd.limit(0), empty).count() == 0


def test_language_of_rare_words_beside_a_large_language(spark, work):
    """70,000 words of one language, each twice, and 3,000 of another, each once, all of the same letters."""
    def word(n, salt):
        return F.substring(F.translate(F.md5(F.concat(n.cast("string"), F.lit(salt))), "0123456789", "ghijklmnop"), 1, 6)

    large = spark.range(70_000).select(F.concat_ws(" ", word(F.col("id"), "l"), word(F.col("id"), "l")).alias("text"), F.lit("large").alias("lang"))
    small = spark.range(1_000).select(
        F.concat_ws(" ", *[word(F.col("id") * 3 + i, "s") for i in range(3)]).alias("text"), F.lit("small").alias("lang")
    )
    both = large.unionByName(small)
    single = both.select(F.explode(F.split("text", " ")).alias("text"), "lang")
    found = language.identify(single, language.fit_languages(both, work)).groupBy("lang").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")
    )
    assert all(r.right > 0.98 for r in found.collect()) and found.count() == 2


def test_language_equals_a_plain_count(spark, work, monkeypatch):
    """A small counted model and the rule of the longest known letter groups, word by word."""
    docs = [(1, "Katze Hund katze, Hündin", "de", "s"), (2, "chat chien chat chaton", "fr", "s"), (3, "cat dog cat 12 dogma", "en", "s")]
    counts = {lang: Counter(language.words_of(t)) for _, t, lang, _ in docs}
    langs, mass = sorted(counts), {lang: c.total() for lang, c in counts.items()}
    never = 0.05 / (max(mass.values()) + 1)

    def logs(of):
        return np.array([math.log((of[lang] + 0.05) / (mass[lang] + 1)) if of[lang] else math.log(never) for lang in langs])

    def votes(word):
        own = {lang: c[word] for lang, c in counts.items()}
        for order in (5, 4, 3, 2, 1):
            if any(own.values()):
                found = logs(own)
                return np.maximum(found, found.max() - 4)
            grams = {lang: Counter(g for w, n in c.items() for g in language.grams_of(w, order) for _ in range(n)) for lang, c in counts.items()}
            mine = [g for g in language.grams_of(word, order) if any(c[g] for c in grams.values())]
            if mine:
                found = np.mean([logs({lang: c[g] for lang, c in grams.items()}) for g in mine], axis=0)
                return np.maximum(found, found.max() - 4)
        return np.zeros(len(langs))

    model = language.fit_languages(spark.createDataFrame(docs, DOCS), work)
    texts = ["katzen und hunde", "les chats", "dogs and cats", "xyz qqq", "hündchen chatons dogmatic"]
    monkeypatch.setattr(language, "REMEMBERED", 2)
    for word in {w for t in texts for w in language.words_of(t)}:
        assert model.word_scores(word) == pytest.approx(votes(word), abs=1e-6)
    found = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in found:
        total = sum(votes(w) for w in language.words_of(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-6)
        assert r.lang_pred == langs[int(np.argmax(np.round(total, 6)))]


def test_language_sample_is_bounded_and_keeps_small_languages(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 100 == 0, "rare").otherwise("large").alias("lang"))
    found = {r["lang"]: (r["n"], r["c"]) for r in language.fit_sample(rows, 20_000).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c")).collect()}
    assert found["rare"][0] == 200 and 8_000 < found["large"][1] < 12_000
    assert language.fit_sample(rows, 10**9).count() == 20_000


# Toxicity


def toxic_corpus(spark, n=600):
    random.seed(4)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(random.choices(words, k=8)) for _ in range(random.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            sentences[random.randrange(len(sentences))] += random.choice([" nastyword", " vilething"])
        rows.append((i, ". ".join(sentences), "en", "s"))
        labels.append((i, int(toxic), 1))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity_finds_documents_and_sentences(spark, work):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit_toxicity(docs.where("doc_id >= 200"), labels.where("doc_id >= 200"), work)
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where("doc_id < 200")
    assert scored.where("predicted <> toxic").count() == 0
    found = toxicity.locate_offences(docs.where("doc_id < 200"), model).collect()
    assert len(found) == 40 and all("nastyword" in r.offence or "vilething" in r.offence for r in found)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.begin:r.end] == r.offence for r in found)


def test_toxicity_of_held_out_documents(spark, work):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = toxicity.fit_toxicity(docs.where(~held_out), labels.where(~held_out), work, fit_rows=6000)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text").join(labels.where(held_out), "doc_id"), model)
    hit, toxic, false, clean = scored.selectExpr(
        "count_if(toxic = 1 and predicted = 1)", "count_if(toxic = 1)", "count_if(toxic = 0 and predicted = 1)", "count_if(toxic = 0)"
    ).first()
    assert hit / toxic > 0.95 and false / clean < 0.02


def test_toxicity_odd_rows(spark, work):
    docs, labels = toxic_corpus(spark, 100)
    odd = spark.createDataFrame([(i, t, "p") for i, t in enumerate(odd_texts())], "doc_id long, text string, predicted string")
    noisy = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, None), (5, 0, 0)], labels.schema))
    for model in (
        toxicity.fit_toxicity(docs, noisy, work), toxicity.fit_toxicity(docs, labels.limit(0), work),
        toxicity.fit_toxicity(docs.limit(0), labels, work), toxicity.fit_toxicity(docs, labels.where("toxic = 1"), work),
    ):
        found = toxicity.score_toxicity(odd, model).collect()
        assert len(found) == len(odd_texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
        located = toxicity.score_toxicity(odd.withColumn("offences", F.lit(1)), model, locate=True)
        assert [r.score for r in located.collect()] == [r.score for r in found]
        assert toxicity.score_toxicity(odd.limit(0), model).count() == 0


# Quality


def test_quality_of_held_out_documents(spark, work):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    model = quality.fit_quality(docs, labels.where(~held_out), work, fit_rows=2500, pool_rows=1000)
    scored = quality.score_quality(docs, model).join(labels, "doc_id").where(held_out)
    good, all_good, bad, all_bad = scored.selectExpr(
        "count_if(quality = 1 and predicted = 1)", "count_if(quality = 1)", "count_if(quality = 0 and predicted = 0)", "count_if(quality = 0)"
    ).first()
    assert good / all_good > 0.9 and bad / all_bad > 0.8


def test_quality_odd_rows(spark, work):
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(odd_texts())], DOCS).withColumn("score", F.lit("s"))
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels, work)
    found = quality.score_quality(docs, model).collect()
    assert model == 1.0 and len(found) == len(odd_texts()) and {r.predicted for r in found} == {1}
    assert quality.fit_quality(docs.limit(0), labels.limit(0), work) == 0.5
    assert quality.score_quality(docs.limit(0), 0.5).count() == 0


def test_quality_fitted_on_repeated_ids(spark, work):
    rows = [(i % 400, ("GOOD prose of length. " if i % 2 else "xx!! $$ ") * (1 + i % 5), "s" if i % 2 else None, "en") for i in range(800)]
    docs = spark.createDataFrame(rows + [(7000 + i, t, None, None) for i, t in enumerate(odd_texts())], DOCS)
    docs = docs.unionByName(spark.createDataFrame([(None, "no id", None, None)] + [(9, "same id", "s", "en")] * 300, DOCS))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels, work, pool_rows=60)
    assert isinstance(model, quality.QualityModel)
    found = quality.score_quality(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    right = [r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 400 and r.doc_id != 9]
    assert sum(right) > 0.95 * len(right)


def test_pool_is_filled_up_with_other_documents(spark):
    ids = spark.range(5_000).withColumnRenamed("id", "doc_id")
    slices = [{r.doc_id for r in quality._hash_slices(ids, 500, 23, 3).where(F.col("slice") == i).collect()} for i in range(3)]
    assert all(400 < len(s) < 600 for s in slices) and len(set.union(*slices)) == sum(map(len, slices))
    assert quality._hash_slices(ids, 6_000, 23, 3).where("slice = 0").count() == 5_000


def test_batches_in_parts():
    import pyarrow as pa

    from staykit.llm.arrow import in_parts

    texts = ["a" * 300, None, "", "b" * 5_000, "c"] * 20
    batch = pa.RecordBatch.from_pydict({"n": list(range(100)), "t": texts})
    for most in (1, 700, 10**9):
        parts = list(in_parts([batch, batch.slice(0, 0)], most))
        assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
        assert len(parts) == {1: 100, 10**9: 1}.get(most, len(parts))


# Decontamination


def brute_hits(items, text, window):
    words, hit, found = decontaminate.words_of(text), set(), set()
    for key, own in items:
        size = min(window, len(own))
        runs = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in runs:
                hit |= set(range(i, i + size))
                found.add(key)
    return len(words), len(hit), found


def test_suffix_automaton_equals_brute_force():
    random.seed(3)
    for _ in range(600):
        letters = [bytes([97 + i]) for i in range(random.randint(1, 5))]
        window = random.choice([2, 3, 4, 13])
        items = [(k, random.choices(letters, k=random.randint(0, random.choice([3, 8, 30])))) for k in range(random.randint(0, 6))]
        texts = [b" ".join(random.choices(letters + [b"zz"], k=random.randint(0, 40))) for _ in range(4)]
        texts += [b" , ".join(words) for _, words in items]
        counts, spans, found = decontaminate.Matcher(decontaminate.SuffixAutomaton(items, window)).match(texts)
        for t, n, s, i in zip(texts, counts, spans, found):
            assert (int(n), sum(b - a for a, b in s), i) == brute_hits(items, t, window)


@pytest.mark.parametrize("block_words", [200_000, 20])
def test_match_benchmark_odd_rows_and_blocks(spark, work, block_words):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [(1, item), (2, item), (3, "short one"), (4, None), (5, ""), (None, "word")]
    texts = [*odd_texts(), f"x {item.upper()}!", "A SHORT, one here", item]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {r.doc_id: r for r in decontaminate.match_benchmark(docs, benchmark, work, block_words=block_words, keep_text=True).collect()}
    known = [(k, decontaminate.words_of((t or "").encode())) for k, t in items if k is not None]
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_hit, set(r["items"])) == brute_hits(known, (t or "").encode(), 13)
        assert sum(s.end - s.begin for s in r.spans) == r.n_hit and r.text == (t or "")
    none = decontaminate.match_benchmark(docs, benchmark.limit(0), work).collect()
    assert {r.n_hit for r in none} == {0}
    assert decontaminate.match_benchmark(docs.limit(0), benchmark, work).count() == 0


def test_cut_spans(spark, work):
    item = "a b c d e f g h i j k l m n"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before, {item}; after"), (2, "nothing here"), (3, None)], "doc_id long, text string")
    matched = decontaminate.match_benchmark(docs, benchmark, work, keep_text=True)
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(matched).collect()}
    assert cut == {1: "Before, ; after", 2: "nothing here", 3: ""}
