"""Lookups and keyed joins.

Every pandas ``.map``, index alignment or ``update`` is an equi-join here.
Broadcast is used only where the small side has a *proven* bound: a literal
dictionary (compiled into a ``map`` expression, no join at all) or a caller
supplied ``max_rows`` that is checked by a count before the hint is added.
Otherwise the join is left to adaptive execution, which broadcasts on the
measured shuffle size and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col


def salted_left_join(df: DataFrame, right: DataFrame, keys: Sequence[str],
                     skip: Column | None = None, salt_buckets: int | None = None,
                     spread: Sequence[str] | None = None) -> DataFrame:
    """Left join on ``keys`` where rows that cannot match are spread out.

    Rows with a NULL key, or where ``skip`` holds (a sentinel group such as
    'Alone' that the right side excludes), would all hash to one shuffle
    partition although they never match. They get a non-zero salt from a hash
    of the row (deterministic, so recomputation is stable); matching rows keep
    salt 0, as does every right-side row. The join is on ``keys + salt``, which
    leaves the result unchanged and the partitions balanced. There are as many
    salts as shuffle partitions. ``spread`` names the columns whose hash is the
    salt (default: all columns that can be hashed). Where no key can be NULL and
    nothing is skipped, the join is on the keys alone.
    """
    ks = list(keys)
    if skip is None and not any(df.schema[k].nullable for k in ks):
        return df.join(right, on=ks, how="left")
    if salt_buckets is None:
        salt_buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if spread is None:
        spread = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    cant = F.lit(False)
    for k in ks:
        cant = cant | F.col(k).isNull()
    if skip is not None:
        cant = cant | F.coalesce(skip, F.lit(False))
    salt = F.when(cant, F.pmod(F.xxhash64(*[F.col(c) for c in spread]),
                               F.lit(salt_buckets - 1)) + 1).otherwise(F.lit(0))
    left = df.withColumn("_salt", salt.cast("int"))
    # The right side's salt is 0, written as a function of its key: a literal
    # would be constant-folded into a filter and the shuffle would ignore it.
    # (A NULL right key gets -1 and, like every NULL key, matches nothing.)
    r_salt = F.when(F.col(ks[0]).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("int")
    return left.join(right.withColumn("_salt", r_salt), on=[*ks, "_salt"], how="left").drop("_salt")


def dict_lookup(key: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Literal dictionary lookup; a missing or NULL key gives NULL, then
    ``default`` when given (e.g. 'Rare')."""
    if not mapping:
        hit = F.lit(None)
    else:
        pairs = []
        for k, v in mapping.items():
            pairs += [F.lit(k), F.lit(v)]
        hit = F.try_element_at(F.create_map(*pairs), col(key))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def replace_values(c: ColumnOrName, mapping: Mapping) -> Column:
    """D1 (``Series.replace``): mapped where the key is present, else unchanged."""
    return F.coalesce(dict_lookup(c, mapping), col(c))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str,
                  value_cols: Sequence[str]) -> DataFrame:
    """Keep-first row per key by ``order`` (pandas ``drop_duplicates``).

    ``min_by`` is a partial aggregate holding one candidate per key per task,
    so a hot key never gathers its rows in one place.
    """
    ks = [key] if isinstance(key, str) else list(key)
    picked = df.groupBy(*ks).agg(
        F.min_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order)).alias("_first"))
    return picked.select(*ks, *[F.col(f"_first.{c}").alias(c) for c in value_cols])


def table_lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str],
                 value: str, out: str | None = None, default: ColumnOrName | None = None,
                 when: Column | None = None, skip: Column | None = None) -> DataFrame:
    """Map a value from a keyed table onto rows, with a fallback.

    ``table`` must be unique on ``on`` (build it with ``first_per_key`` or an
    aggregate). Rows where ``when`` is false keep their current ``out`` value.
    ``skip`` marks rows whose key is known to be absent from ``table`` (e.g. a
    sentinel group); they are salted so a huge sentinel never lands in one task.
    """
    ks = [on] if isinstance(on, str) else list(on)
    out = out or value
    tmp = f"_lk_{value}"
    right = table.select(*ks, F.col(value).alias(tmp))
    joined = salted_left_join(df, right, ks, skip)
    mapped = F.col(tmp) if default is None else F.coalesce(F.col(tmp), col(default))
    if when is not None and out in df.columns:
        mapped = F.when(F.coalesce(when, F.lit(False)), mapped).otherwise(F.col(out))
    return joined.withColumn(out, mapped).drop(tmp)


def keyed_update(base: DataFrame, override: DataFrame, on: str | Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` where the override row exists and is non-null
    (``DataFrame.update``). A duplicated override key keeps the value with the
    greatest key order deterministically (max) so the base never gains rows."""
    ks = [on] if isinstance(on, str) else list(on)
    ov = override.groupBy(*ks).agg(*[F.max(c).alias(f"_ov_{c}") for c in columns])
    joined = salted_left_join(base, ov, ks)
    return joined.withColumns({c: F.coalesce(F.col(f"_ov_{c}"), F.col(c)) for c in columns}
                              ).drop(*[f"_ov_{c}" for c in columns])


def align_assign(df: DataFrame, other: DataFrame, on: str | Sequence[str],
                 columns: Mapping[str, str]) -> DataFrame:
    """Index-aligned assignment ``df[new] = other[src]`` as a left join.

    ``other`` must be unique on the key (an index); a duplicated key keeps the
    maximum so ``df`` never gains rows. The dedupe aggregate is partitioned by
    the key, which the join then reuses.
    """
    ks = [on] if isinstance(on, str) else list(on)
    right = other.groupBy(*ks).agg(*[F.max(src).alias(dst) for dst, src in columns.items()])
    return salted_left_join(df.drop(*[c for c in columns if c in df.columns]), right, ks)


def select_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``loc[index_list]`` as a left-semi join (no duplication)."""
    return df.join(keys, on=on, how="left_semi")


def align_truth(pred: DataFrame, truth: DataFrame, on: str | Sequence[str],
                pred_col: str, truth_col: str) -> DataFrame:
    """Inner join of predictions and truth on the key."""
    ks = [on] if isinstance(on, str) else list(on)
    return pred.select(*ks, F.col(pred_col).alias("prediction")).join(
        truth.select(*ks, F.col(truth_col).alias("truth")), on=ks, how="inner")
