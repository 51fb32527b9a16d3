"""Validation and normalisation of message arrays."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.schemas import ROLES

# The two reasons for turning a conversation down.
EMPTY = "empty conversation"
UNKNOWN_ROLE = "unknown role"


def as_text(value: Column, kind: T.DataType) -> Column:
    """`value` as text, with a missing value written `None` and booleans `True`/`False`.

    Floating-point numbers are written with the shortest digits that give the number back, plainly
    from 0.0001 up to 10^16 and with a signed two-digit exponent beyond; arrays and structs are refused.
    """
    if isinstance(kind, T.BooleanType):
        value = F.initcap(value.cast("string"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = float_text(value.cast("double"))
    elif not isinstance(kind, (T.StringType, T.IntegralType, T.NullType)):
        raise TypeError(f"cast {kind.simpleString()} content to string first")
    return F.coalesce(value.cast("string"), F.lit("None"))


def float_text(x: Column) -> Column:
    """The shortest text of a double. Spark has the digits (two at least for the smallest subnormal
    number); the point and the exponent go elsewhere."""
    shown = x.cast("string")
    sign = F.when(shown.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(F.regexp_extract(shown, r"^-?([0-9.]+)", 1), r"\.0$", ""), r"\.", "")
    power = F.regexp_extract(shown, r"E(-?[0-9]+)$", 1)
    exponent = F.when(power == "", F.lit(0)).otherwise(power.try_cast("int"))
    tail = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit(""))
    width = F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit(""))
    scientific = F.concat(
        sign, F.left(digits, F.lit(1)), tail, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), width, F.abs(exponent).cast("string")
    )
    large = F.concat(sign, F.rpad(digits, exponent + 1, "0"), F.lit(".0"))
    cut = F.concat(sign, F.left(digits, exponent + 1), F.lit("."), F.substr(digits, exponent + 2))
    whole = F.when(F.length(digits) <= exponent + 1, large).otherwise(cut)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), F.abs(exponent) - 1), digits)
    return (
        F.when(F.isnan(x), "nan")
        .when(x == float("inf"), "inf")
        .when(x == float("-inf"), "-inf")
        .when(power == "", shown)
        .when((exponent >= 16) | (exponent < -4), scientific)
        .when(exponent >= 0, whole)
        .otherwise(small)
    )


def has_unknown_role(messages: Column) -> Column:
    return F.exists(messages, lambda m: ~F.coalesce(m["role"].isin(*ROLES), F.lit(False)))


def n_messages(messages: Column) -> Column:
    return F.when(messages.isNull(), F.lit(0)).otherwise(F.size(messages))


def reason_of(n: Column, unknown_role: Column) -> Column:
    return F.when(n == 0, F.lit(EMPTY)).when(unknown_role, F.lit(UNKNOWN_ROLE))


def reject_reason(messages: Column) -> Column:
    """Why a conversation is not usable, or null when it is.

    An unknown role wins over nothing else: an empty list has no roles to look at.
    """
    return reason_of(n_messages(messages), has_unknown_role(messages))


def normalize_messages(df: DataFrame, name: str, fail: bool = False) -> Column:
    """Keep `role` and `content` of each message, content as text, order untouched.

    With `fail=True` a bad conversation raises from inside the value itself, so that the optimiser
    cannot drop the check while the value is used.
    """
    kind = df.schema[name].dataType.elementType["content"].dataType
    messages = F.col(name)
    clean = F.transform(
        messages,
        lambda m: F.struct(m["role"].cast("string").alias("role"), as_text(m["content"], kind).alias("content")),
    )
    if not fail:
        return clean
    reason = reject_reason(messages)
    return F.when(reason.isNull(), clean).otherwise(F.raise_error(F.concat(reason, F.lit(f" in {name}"))))


def common_prefix_size(left: Column, right: Column) -> Column:
    """How many leading messages two conversations share, in one pass over the pair."""
    same = F.zip_with(left, right, lambda a, b: a.eqNullSafe(b))
    differs_at = F.array_position(same, False)
    return F.when(differs_at == 0, F.size(same)).otherwise(differs_at - 1).cast("int")


def split_common_prompt(chosen: Column, rejected: Column) -> dict[str, Column]:
    """Shared leading messages as `prompt`, and what is left of either side."""
    shared = common_prefix_size(chosen, rejected)
    return {
        "prompt": F.slice(chosen, F.lit(1), shared),
        "chosen": F.slice(chosen, shared + 1, F.size(chosen)),
        "rejected": F.slice(rejected, shared + 1, F.size(rejected)),
    }
