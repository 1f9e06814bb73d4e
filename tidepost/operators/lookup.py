"""Equi joins against keyed tables.

No side of the keyed joins is forced to be broadcast: Catalyst does that below its size threshold,
and adaptive execution with measured sizes. Beyond it they are sort-merge joins that stand a hot
key. Besides the key they compare its hash, which on the left is a hash of the whole row where the
key is null: rows without a key are spread over all partitions, and because the second column is
not part of an earlier grouping, both inputs get shuffles of their own, which adaptive execution
needs to split a skewed partition. ``salts`` spreads the left rows by hand where adaptive
execution is off, at the price of repeating the right side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidepost.functions.text import (
    PLAN_BYTES,
    clean_text,
    dictionary_bytes,
    map_of,
    normalize_tokens,
    replace_tokens_by,
    strip,
)
from tidepost.operators.shape import compute_once
from tidepost.session import materialize


# Largest table of strings that is broadcast on purpose, by its measured content.
BROADCAST_BYTES = 64 * 1024 * 1024
# Bits of a filter of values: 8 MB.
FILTER_BITS = 1 << 26
# Maps of a dictionary that is one value.
MOST_MAPS = 1 << 17


def measured_bytes(strings: DataFrame) -> int:
    """Bytes in the string columns of a table, plus a fixed amount per row."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings.columns), F.lit(64))
    return strings.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def _spread(
    left: DataFrame, right: DataFrame, on: str, salts: int, row: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the additional join columns, and all join columns.

    Rows are told apart by ``row``, all columns of the left side if it isn't given.
    """
    row = left.columns if row is None else row
    key = F.hash(F.col(on).cast("string"))  # equal for numbers of different width
    left = left.withColumn("_hash", F.when(F.col(on).isNull(), F.hash(*row)).otherwise(key))
    right = right.withColumn("_hash", key)
    if salts <= 1:
        return left, right, [on, "_hash"]
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*row), F.lit(salts)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left, right, [on, "_hash", "_salt"]


def digest_of(column: str) -> Column:
    """Digest of a string as 32 bytes; null for null."""
    return F.unhex(F.sha2(F.col(column), 256))


def exclude_matches(
    df: DataFrame,
    known: DataFrame,
    on: str,
    known_column: str | None = None,
    salts: int = 1,
    row: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose ``on`` value does not occur in ``known``; null never matches, so it stays.

    Strings are compared by their digest, so a text is not a shuffle key and none is sent from
    ``known``. Repeated keys of ``known`` do no harm to an anti join and are left in. ``row`` names the
    columns by which rows without a key are spread, where not all columns are to be read for it.
    """
    source = known_column or on
    as_text = df.schema[on].dataType == known.schema[source].dataType == StringType()
    left_key, right_key = (
        F.sha2(F.col(c), 256) if as_text else F.col(c) for c in (on, source)
    )
    keys = known.select(right_key.alias("_key")).filter(F.col("_key").isNotNull())
    left, right, columns = _spread(df.withColumn("_key", left_key), keys, "_key", salts, row)
    return left.join(right, columns, "left_anti").select(*df.columns)


def attach_predictions(
    df: DataFrame,
    predictions: DataFrame,
    on: str,
    best: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """Left outer join on a key; the number of rows of ``df`` does not change.

    ``best`` names the prediction columns, strongest criterion first: of several predictions for
    a key the one with the largest values is used.
    """
    one = (
        predictions.filter(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.max(F.struct(*best)).alias("_best"))
        .select(on, *[F.col(f"_best.{c}").alias(c) for c in best])
    )
    left, right, columns = _spread(df, one, on, salts)
    return left.join(right, columns, "left").select(*df.columns, *best)


def _bit(value: Column, bits: int) -> Column:
    """Number of a value's bit in a filter, from 1."""
    return F.pmod(F.xxhash64(value), F.lit(bits)) + 1


def occurring(values: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """A filter of the values of a column: ``part, map``, one bit for each hash that occurs.

    Bits are set where the values are, and only maps of 4,096 bytes are shuffled; the whole filter has
    at most ``bits / 8`` bytes, whatever the number of values.
    """
    bit = _bit(F.col(column), bits)
    return values.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map")
    )


def possible(values: DataFrame, column: str, filter_: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose value can be among those of a filter: all that are, and few others."""
    bit = _bit(F.col(column), bits)
    place = F.bitmap_bit_position(bit)
    byte = F.substring(F.col("map"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, _place)").bitwiseAND(1) == 1
    return (
        values.withColumn("part", F.bitmap_bucket_number(bit))
        .join(F.broadcast(filter_), "part")  # at most bits / 8 bytes
        .withColumns({"_byte": value, "_place": (place % 8).cast("int")})
        .filter(is_set)
        .select(*values.columns)
    )


def dictionary_maps(entries: DataFrame, maps: int, token: str = "token", form: str = "form") -> Column:
    """A dictionary as one value, an array of maps by ``map_of``, from a scalar subquery.

    The table is read once for the whole query, and none of it is part of the plan. ``token`` must
    identify entries; null and empty tokens are left out.
    """
    filled = (
        entries.filter(F.col(token) != "")
        .groupBy(map_of(F.col(token), maps).alias("place"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col(token), F.col(form)))).alias("forms"))
    )
    every = entries.sparkSession.range(maps).select(F.col("id").cast("int").alias("place"))
    listed = F.collect_list(F.struct("place", "forms"))
    ordered = F.array_sort(listed, lambda a, b: a.place - b.place)
    return every.join(filled, "place", "left").agg(F.transform(ordered, lambda x: x.forms)).scalar()


def with_forms(df: DataFrame, text: str, lookup: Mapping[str, str] | None) -> DataFrame:
    """Replace whole tokens of a column by their dictionary form, whatever the dictionary's size.

    Up to ``PLAN_BYTES`` it is a constant of the plan, up to ``BROADCAST_BYTES`` one value that a scalar
    subquery gives every task, and beyond that a table that is joined.
    """
    entries = {k: v for k, v in (lookup or {}).items() if k}
    size = dictionary_bytes(entries)
    if size <= PLAN_BYTES:
        return df.withColumn(text, normalize_tokens(text, entries))
    rows = df.sparkSession.createDataFrame(list(entries.items()), "token string, form string")
    rows = materialize(rows, "dictionary")
    if size > BROADCAST_BYTES:
        return normalize_tokens_join(df, text, rows)
    maps = min(len(entries), MOST_MAPS)
    # a column of its own, as a subquery can't stand within a function of an array's elements
    return (
        df.withColumn("_maps", dictionary_maps(rows, maps))
        .withColumn(text, replace_tokens_by(text, F.col("_maps"), maps))
        .drop("_maps")
    )


def with_clean_text(
    df: DataFrame, source: str, target: str, lookup: Mapping[str, str] | None
) -> DataFrame:
    """Add the cleaned text of a column, computed once, with the forms of a dictionary of any size."""
    small = dictionary_bytes(lookup) <= PLAN_BYTES
    cleaned = compute_once(df, **{target: clean_text(source, lookup if small else None)})
    return cleaned if small else with_forms(cleaned, target, lookup)


def normalize_tokens_join(
    df: DataFrame,
    text: str,
    lookup: DataFrame,
    token: str = "token",
    form: str = "form",
    salts: int = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Dictionary replacement as a join, for a dictionary too large for an expression.

    ``token`` must identify dictionary entries. Texts are known by their digest, so rows need no
    key and equal texts share one map of replacements, from which each is rebuilt. The dictionary
    is broadcast if its measured size allows it. If not, it is reduced to entries that can occur in
    the texts (a filter of bits, ``occurring``) and written; what is left is broadcast if it is small
    enough now, else merged with those tokens of the texts that can be in it. Only tokens of
    the dictionary are shuffled. Rows of a digest that very many rows share are split by adaptive
    execution, or by hand with ``salts``.
    """
    forms = lookup.select(F.col(token).alias("_token"), F.col(form).alias("_form"))
    digest = F.sha2(F.col(text), 256).alias("_digest")
    tokens = df.select(digest, F.explode(F.array_distinct(F.split(text, " "))).alias("_token"))
    tokens = tokens.filter(F.col("_token") != "")
    if measured_bytes(forms) > broadcast_bytes:
        forms = materialize(possible(forms, "_token", occurring(tokens, "_token")), "dictionary")
        if measured_bytes(forms) > broadcast_bytes:
            tokens = possible(tokens, "_token", materialize(occurring(forms, "_token"), "filter"))
            # Spark takes the exploded tokens for as small as the texts they come from
            forms = forms.hint("merge")
        else:
            forms = F.broadcast(forms)
    else:
        forms = F.broadcast(forms)
    hits = (
        tokens.join(forms, "_token")
        .groupBy("_digest")
        .agg(F.map_from_entries(F.collect_set(F.struct("_token", "_form"))).alias("_forms"))
    )
    replaced = F.transform(
        F.split(text, " "), lambda x: F.coalesce(F.try_element_at("_forms", x), x)
    )
    replaced = F.when(F.col("_forms").isNull(), F.col(text)).otherwise(
        strip(F.array_join(replaced, " "))
    )
    left, right, columns = _spread(df.withColumn("_digest", digest), hits, "_digest", salts)
    return left.join(right, columns, "left").withColumn(text, replaced).select(*df.columns)
