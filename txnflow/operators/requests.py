"""Scoring requests as JSON text: their fields as typed columns, and what is wrong with them.

A field that is absent is told apart from one that is there and can't be read. Only the fields that a rule computes with
are read as numbers; the others just have to be there, whatever their value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.functions.numbers import parse_double
from txnflow.schema import REQUEST

UNREADABLE = "unreadable request"
ANSWERED, REFUSED, FAILED = 200, 400, 500

# The wording for values that are no numbers, by the type wanted.
WRONG_TEXT = {"float": "could not convert string to float: ", "int": "invalid literal for int() with base 10: "}
WRONG_TYPE = {
    "float": "float() argument must be a string or a real number, not ",
    "int": "int() argument must be a string, a bytes-like object or a real number, not ",
}


# A request as it is sent as a rule: a flat object of plain numbers, in the order of the schema. Each field stands there once at most.
# No sign, since the text of a variant drops that of a zero.
_DIGITS = r"(?:0|[1-9][0-9]{0,8})"
_SENT = r"^\{" + "".join(
    rf'(?:"{f.name}":{_DIGITS}{"" if isinstance(f.dataType, T.IntegerType) else r"(?:[.][0-9]{1,15})?(?:E-?[0-9]{1,2})?"}(?:,(?=")|(?=\}})))?'
    for f in REQUEST.fields) + r"\}$"
_PLAIN = "NUMBER"
_SENT_FIELDS = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in REQUEST.fields)


def _quoted(text: Column) -> Column:
    """The text in quotes as the messages show it: double ones if it holds single ones only."""
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(char), F.lit(shown))
    single, double = text.contains("'"), text.contains('"')
    return F.when(single & ~double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _number(field: T.StructField) -> Column:
    """The value of a field, out of its ``_kind_`` and ``_text_``, if it can be read."""
    kind, text = F.col(f"_kind_{field.name}"), F.col(f"_text_{field.name}")
    number = F.when(kind == "BOOLEAN", (text == "true").cast("double")).when(~_is_other(kind), parse_double(text))
    if isinstance(field.dataType, T.IntegerType):
        # Text must be a whole number; the fraction of a number is cut off.
        number = F.when((kind != "STRING") | F.trim(text).rlike(r"^[+-]?[0-9]+$"), number).try_cast("int")
    return number


def _is_other(kind: Column) -> Column:
    return (kind == "VOID") | kind.startswith("ARRAY") | kind.startswith("OBJECT")


def _problem(field: T.StructField) -> Column:
    """What is wrong with a field that is there; null for one that can be read."""
    kind, text = F.col(f"_kind_{field.name}"), F.col(f"_text_{field.name}")
    wanted = "int" if isinstance(field.dataType, T.IntegerType) else "float"
    type_name = F.when(kind == "VOID", "'NoneType'").when(kind.startswith("ARRAY"), "'list'").otherwise("'dict'")
    return F.when(kind.isNotNull() & F.col(field.name).isNull(), F.when(
        _is_other(kind), F.concat(F.lit(WRONG_TYPE[wanted]), type_name)).otherwise(F.concat(F.lit(WRONG_TEXT[wanted]), _quoted(text))))


def read_requests(requests: DataFrame, column: str = "value", keep: Sequence[str] = (), parse_all: bool = False) -> DataFrame:
    """``request``, ``readable`` (whether the text is JSON), ``parsed``, the fields as typed columns, and ``keep``.

    Requests of plain numbers are read as such, and parsed as a variant only with ``parse_all``. What a field of any other needs to be
    judged by is taken out of its variant once, in columns of their own: its type as ``_kind_``, null for an absent field, and
    its text as ``_text_``.
    """
    clash = sorted({"request", "response", "status", "error", "readable", "parsed", *REQUEST.names} & set(keep))
    if clash:
        raise ValueError(f"columns of these names can't be kept: {', '.join(clash)}")
    judged = requests.select(*keep, F.col(column).alias("request"), F.coalesce(F.col(column).rlike(_SENT), F.lit(False)).alias("_plain"))
    parse, sent = F.try_parse_json("request"), F.from_json("request", _SENT_FIELDS)
    parsed = judged.select(
        *keep, "request", "_plain", (parse if parse_all else F.when(~F.col("_plain"), parse)).alias("parsed"),
        F.when(F.col("_plain"), sent).alias("_sent"))
    found = parsed.select("*", *[column for name in REQUEST.names for column in (
        F.when(F.col("_plain"), F.when(F.col(f"_sent.{name}").isNotNull(), _PLAIN)).otherwise(
            F.schema_of_variant(F.try_variant_get("parsed", f"$.{name}", "variant"))).alias(f"_kind_{name}"),
        F.when(~F.col("_plain"), F.try_variant_get("parsed", f"$.{name}", "string")).alias(f"_text_{name}"))])
    return found.select(
        *keep, "request", (F.col("_plain") | F.col("parsed").isNotNull()).alias("readable"), "parsed",
        *[f"_{part}_{name}" for name in REQUEST.names for part in ("kind", "text")],
        *[F.when(F.col("_plain"), F.col(f"_sent.{f.name}")).otherwise(_number(f)).alias(f.name) for f in REQUEST.fields])


def request_error(required: Sequence[str], used: Sequence[str]) -> Column:
    """What is wrong with a request of :func:`read_requests`: no JSON, the first absent field, or the first unreadable one of those used."""
    return F.when(~F.col("readable"), F.lit(UNREADABLE)).otherwise(F.coalesce(
        *[F.when(F.col(f"_kind_{f}").isNull(), F.lit(f"Missing field: {f}")) for f in required],
        *[_problem(REQUEST[f]) for f in used]))


def status_of(error: Column) -> Column:
    """200 for an answer, 400 for an absent field, 500 for what can't be read."""
    return F.when(error.isNull(), ANSWERED).when(error.startswith("Missing field: "), REFUSED).otherwise(FAILED)
