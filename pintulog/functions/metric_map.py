"""The ``map`` dialect: the first ``Metric Value: {...}`` block as key/value pairs.

Pairs are separated by ``", "``, split at their first ``=``, the last duplicate of a
key wins, parts without ``=`` are ignored, and the block ends at its first ``}``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a metric block looks in the log text.
METRIC_BLOCK = r"Metric Value: \{([^}\n]*)\}"

METRIC_OPEN = r"Metric Value: \{([^\n]*)"

_ALL_DIGITS = r"\A[0-9]+\z"


def has_metrics(log: str | Column = "log") -> Column:
    log = F.col(log) if isinstance(log, str) else log
    return log.rlike(METRIC_BLOCK)


def metric_text(log: str | Column = "log", balanced: bool = False) -> Column:
    """Inside of the block, led by the separator so every pair starts alike.

    A ``balanced`` block ends at the brace that closes it, so values may hold pairs of braces; one
    whose braces do not balance in its line ends at its first ``}`` as by default.
    """
    text = F.regexp_extract(log, METRIC_BLOCK, 1)
    if balanced:
        text = F.coalesce(balanced_block(log), text)
    return F.concat(F.lit(", "), text)


def balanced_block(log: str | Column = "log") -> Column:
    """What the first block holds up to the brace that closes it; null if none does.

    Between two closing braces only the number of opening ones counts, so the text is cut at
    the closing ones and the depth kept along the parts.
    """
    rest = F.regexp_extract(log, METRIC_OPEN, 1)
    parts = F.split(rest, "}", -1)

    def step(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.length(part) - F.length(F.replace(part, F.lit("{"), F.lit(""))) - 1
        ended = state["depth"] == 0
        return F.struct(F.when(ended, 0).otherwise(depth).alias("depth"), F.when(ended, state["parts"]).otherwise(state["parts"] + 1).alias("parts"))

    # the last part has no closing brace after it
    closed = F.slice(parts, 1, F.size(parts) - 1)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("parts"))
    return F.aggregate(closed, start, step, lambda end: F.when(end["depth"] == 0, F.array_join(F.slice(parts, 1, end["parts"]), "}")))


def metric_values(keys: list[str], metrics: str = "metrics") -> Column:
    """The values of ``keys``, all letters, as a struct of texts, from one pass over a metric text.

    The last pair of a key wins; a key without a pair is null. Every part of the text becomes a
    field of a JSON object, those that are no pair or of a key with other characters under the
    name "", and Spark reads the object's fields by name. A search per key cost several times
    as much, most of it in going over the same text again.
    """
    part = "([^,]*+(?:,(?! )[^,]*+)*+)"
    quoted = F.regexp_replace(metrics, r"([\"\\])", r"\\$1")
    object_fields = F.regexp_replace(quoted, f", (?:([A-Za-z]{{1,64}}+)=)?+{part}", '"$1":"$2",')
    schema = ", ".join(f"`{key}` string" for key in keys)
    return F.from_json(F.concat(F.lit("{"), object_fields, F.lit('"":""}')), schema, {"allowUnquotedControlChars": "true"})


def is_whole_number(value: Column) -> Column:
    return value.rlike(_ALL_DIGITS)


def as_int(value: Column) -> Column:
    return F.when(is_whole_number(value), value.try_cast("int"))


def metric_pairs(metrics: str | Column = "metrics") -> Column:
    """All pairs of a :func:`metric_text` column as array<struct<key,value>>."""
    parts = F.filter(F.split(metrics, ", "), lambda p: p.contains("="))
    return F.transform(
        parts,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.substr(p, F.instr(p, "=") + 1).alias("value"),
        ),
    )


def last_wins_map(pairs: str = "pairs") -> Column:
    """map<string,string> of a pairs column, the last duplicate winning.

    Lines without a repeated key, practically all of them, take the direct build;
    only the others pay for the search per key.
    """
    keys = F.col(pairs)["key"]
    distinct_keys = F.array_distinct(keys)
    last_values = F.transform(
        distinct_keys,
        lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"],
    )
    return F.when(
        F.size(distinct_keys) == F.size(keys), F.map_from_arrays(keys, F.col(pairs)["value"])
    ).otherwise(F.map_from_arrays(distinct_keys, last_values))


def value_kind(value: str | Column) -> Column:
    """``bool``, ``int`` or ``str``: how an untyped metric value reads; digits beyond 64 bits stay text."""
    value = F.col(value) if isinstance(value, str) else value
    return (
        F.when(F.lower(value).isin("true", "false"), "bool")
        .when(is_whole_number(value) & value.try_cast("bigint").isNotNull(), "int")
        .otherwise("str")
    )
