"""Account keys: how an operator spells an account, and the cipher that hides the number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

SEPARATOR = "::"


@dataclass(frozen=True)
class Operator:
    """How one operator's account numbers and keys are formed.

    ``with_division`` gives a three-part key (operator, division, billing id), otherwise two parts.
    ``drop_prefix`` characters are cut off the account number, ``pad_to`` left-pads a shorter one with zeros.
    ``has_system`` is False where the operator's history carries no billing-system code.
    ``call_code`` is what the operator is called in the support-call log.
    """

    name: str
    with_division: bool = False
    drop_prefix: int = 0
    pad_to: int = 0
    has_system: bool = True
    call_code: str | None = None


OPERATORS = (
    Operator("OP_A", drop_prefix=3, has_system=False, call_code="A"),
    Operator("OP_B", call_code="B"),
    Operator("OP_C", with_division=True, pad_to=9, call_code="C"),
)


class AccountCipher:
    """Deterministic AES for account numbers.

    Encrypted ids are join keys, so equal inputs must give equal outputs: ECB, not the random-IV default. Equality of
    accounts is therefore visible by construction. ``key`` is a Column so that it can come from a protected table; a
    literal would be readable in the query plan.
    """

    def __init__(self, key: Column):
        self.key = key

    def encrypt(self, plain: Column) -> Column:
        return F.base64(F.aes_encrypt(plain, self.key, F.lit("ECB"), F.lit("PKCS")))

    def decrypt(self, secret: Column) -> Column:
        return F.aes_decrypt(F.unbase64(secret), self.key, F.lit("ECB"), F.lit("PKCS")).cast("string")


def account_guid(operator: Column, division: Column, billing_id: Column, operators=OPERATORS) -> Column:
    """The universal account key. NULL parts are skipped; an unknown operator keeps the bare billing id."""
    three = [o.name for o in operators if o.with_division]
    two = [o.name for o in operators if not o.with_division]
    return (
        F.when(operator.isin(three), F.concat_ws(SEPARATOR, operator, division, billing_id))
        .when(operator.isin(two), F.concat_ws(SEPARATOR, operator, billing_id))
        .otherwise(billing_id)
    )


def billing_id(account_number: Column, operator: Operator, cipher: AccountCipher | None = None) -> Column:
    """Billing id from an account number, decrypting first and encrypting again when a cipher is given."""
    if not (operator.drop_prefix or operator.pad_to):
        return account_number
    plain = cipher.decrypt(account_number) if cipher else account_number
    if operator.drop_prefix:
        plain = F.substr(plain, F.lit(operator.drop_prefix + 1))
    if operator.pad_to:
        plain = F.when(F.length(plain) < operator.pad_to, F.lpad(plain, operator.pad_to, "0")).otherwise(plain)
    return cipher.encrypt(plain) if cipher else plain
