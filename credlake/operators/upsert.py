"""Keyed upserts on immutable tables (K-03..K-07).

``upsert(target, source, keys, ...)`` returns the *new* table content as a
DataFrame; committing it is the store's job.  One function covers every
flavour of ``INSERT ... ON CONFLICT``:

=====================  ==========================================  ==========
flavour                ``update_cols``                             used by
=====================  ==========================================  ==========
full upsert (K-03)     every non-key column                        silver
insert-ignore (K-04)   ``[]``                                      producto, tiempo
SCD-1 dimension (K-05) every attribute; surrogate key kept         cliente
partial upsert (K-06)  the listed measures only; FKs kept          fact
one-column (K-07)      one column                                  proxy
=====================  ==========================================  ==========

Rows only in the target are kept (upserts never delete).  New rows get
surrogate keys continuing after the target's maximum (G-09).

Plans.

* Integer or date key (silver, client, fact, time, proxy): no join.  Target and
  source rows are stacked and partitioned once by key range; one window per
  range, in (key, side) order, pairs each target row with the source row behind
  it, tags source rows without a target row as new, and numbers those.  A range
  holds at most 65,536 keys, so no window grows with the data.  With surrogate keys to assign the
  tagged rows are stored once (``materialize``); new rows per range, counted
  from narrow columns of them, give the offsets, so the keys are added while
  the rows are read back.
* Other keys (product names, several columns): ``DO NOTHING`` keeps the target
  as it is and adds the rows of an anti join; an update goes through one full
  outer join with tagged rows.  New rows are stored and numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .keys import assign_keys, bucketable, key_bucket, max_key


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], *, update_cols: list[str] | None = None,
           touch_cols: list[str] | None = None, stamp_cols: list[str] | None = None, sk_col: str | None = None,
           now: Column | None = None, start: int | None = None) -> DataFrame:
    """``INSERT source ON CONFLICT (keys) DO UPDATE SET update_cols, touch_cols = now``.

    ``update_cols=None`` means every non-key, non-surrogate source column;
    ``[]`` means ``DO NOTHING``.  ``touch_cols`` are set to ``now`` on
    insert and on update (load-time columns), ``stamp_cols`` on insert alone.
    Target columns missing from the source are NULL on insert.  ``start``: the
    largest surrogate key in use, where ``target`` is only a part of its table.

    A source key that occurs twice raises, as ``ON CONFLICT DO UPDATE`` does
    on a double hit; the check runs in the partitioning the upsert needs
    anyway.  NULL keys hit nothing.
    """
    touch, stamp = list(touch_cols or []), [*(touch_cols or []), *(stamp_cols or [])]
    tcols = target.columns
    if update_cols is None:
        update_cols = [c for c in source.columns if c in tcols and c not in keys and c != sk_col and c not in stamp]
    row = _Row(target, source, set(update_cols), touch, stamp, now if now is not None else _now())
    has_sk = sk_col is not None and sk_col not in source.columns
    if bucketable(target, keys):
        return _one_pass(target, source, keys[0], row, sk_col if has_sk else None, start)
    if update_cols:
        merged = _one_join(target, _unique(source, keys), keys, row)
        if not has_sk:
            return merged.select(*tcols)
        merged = materialize(merged)
        kept, new = merged.where(~F.col("_new")).select(*tcols), merged.where("_new")
    else:
        kept = target
        new = source.join(target.select(*keys), keys, "left_anti").withColumn("_now", row.now).selectExpr(
            *[f"{row.inserted(c, _name)} AS `{c}`" for c in tcols])
        new = materialize(new) if has_sk else new
    if has_sk:
        new = assign_keys(new.drop(sk_col), sk_col, keys, start=max_key(target, sk_col) if start is None else start,
                          key_type=row.schema[sk_col])
    return kept.unionByName(new.select(*tcols))


def _name(c: str) -> str:
    return f"`{c}`"


class _Row:
    """What each target column becomes, as SQL over rows that carry the load time as ``_now``; source values
    come through a function from name to expression.  (Text, because a wide table would otherwise cost
    hundreds of calls to build its plan.)"""

    def __init__(self, target: DataFrame, source: DataFrame, update: set, touch: list, stamp: list, now: Column):
        self.schema = {f.name: f.dataType.simpleString() for f in target.schema.fields}
        self.given = set(source.columns) & set(self.schema)
        self.update, self.touch, self.stamp, self.now = update, touch, stamp, now

    def inserted(self, c: str, source) -> str:
        value = "_now" if c in self.stamp else source(c) if c in self.given else "NULL"
        return f"CAST({value} AS {self.schema[c]})"

    def updated(self, c: str, hit: str, old: str, source) -> str:
        """The value of a target row; ``hit``: the source holds its key."""
        if c in self.touch and self.update:
            return f"CAST(CASE WHEN {hit} THEN _now ELSE {old} END AS {self.schema[c]})"
        return f"CAST(CASE WHEN {hit} THEN {source(c)} ELSE {old} END AS {self.schema[c]})" if c in self.update else old


_TWICE = "CAST(raise_error(concat('upsert: the source holds a key twice: ', {key})) AS BOOLEAN)"


def _unique(source: DataFrame, keys: list[str]) -> DataFrame:
    cols = source.columns
    hits = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in keys)
    key = "concat_ws(', ', " + ", ".join(f"CAST(`{c}` AS STRING)" for c in keys) + ")"
    return source.withColumn("_hits", hits).where(f"CASE WHEN _hits > 1 AND {known} THEN {_TWICE.format(key=key)} ELSE true END").select(*cols)


def _one_join(target: DataFrame, source: DataFrame, keys: list[str], row: _Row) -> DataFrame:
    """One full outer join, each side shuffled once and the source read once; ``_new`` tags inserted rows."""
    s = source.selectExpr(*map(_name, keys), *[f"`{c}` AS `_s_{c}`" for c in source.columns if c not in keys], "true AS _s_hit")
    j = target.withColumn("_t_hit", F.lit(True)).join(s, keys, "full_outer").withColumn("_now", row.now)

    def theirs(c: str) -> str:
        return _name(c if c in keys else f"_s_{c}")

    return j.selectExpr(*[f"CASE WHEN _t_hit IS NULL THEN {row.inserted(c, theirs)} ELSE {row.updated(c, '_s_hit IS NOT NULL', _name(c), theirs)} "
                          f"END AS `{c}`" for c in target.columns], "_t_hit IS NULL AS _new")


def _one_pass(target: DataFrame, source: DataFrame, key: str, row: _Row, sk_col: str | None, start: int | None) -> DataFrame:
    """Stack, partition by key range, pair and number in one window; the offsets come from the stored rows."""
    tcols, given = target.columns, [c for c in source.columns if c in row.given and c != key]
    mine = target.selectExpr(f"`{key}` AS _k", f"struct({', '.join(map(_name, tcols))}) AS _t")
    theirs = source.selectExpr(f"CAST(`{key}` AS {row.schema[key]}) AS _k", f"struct({', '.join(['true AS _hit', *map(_name, given)])}) AS _s")
    both = mine.unionByName(theirs, allowMissingColumns=True)
    both = both.select("*", key_bucket(both, "_k").alias("_bkt"), F.col("_t").isNull().alias("_src"))
    w = "OVER (PARTITION BY _bkt ORDER BY _k, _src)"
    again = f"_src AND lag(_k) {w} = _k"  # a row of this key came before
    both = both.selectExpr(
        "*", f"CASE WHEN NOT _src AND lead(_k) {w} = _k THEN lead(_s) {w} END AS _after", f"coalesce({again}, false) AS _again",
        f"coalesce({again} AND lag(_src) {w}, false) AS _twice")
    both = both.selectExpr("*", "_src AND NOT _again AS _new", "sum(CAST(_src AND NOT _again AS INT)) OVER (PARTITION BY _bkt ORDER BY _k, _src "
                           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pos")
    twice = f"CASE WHEN _twice THEN {_TWICE.format(key='CAST(_k AS STRING)')} ELSE NOT _again END"

    def value(c: str) -> str:
        if c == key:
            return "_k"
        old = row.updated(c, "_after._hit", f"_t.`{c}`", lambda x: "_k" if x == key else f"_after.`{x}`")
        return f"CASE WHEN _new THEN {row.inserted(c, lambda x: f'_s.`{x}`')} ELSE {old} END"

    tagged = both.where(twice if row.update else "NOT _again").withColumn("_now", row.now).selectExpr(
        *[f"{value(c)} AS `{c}`" for c in tcols], "_bkt", "_new", "_pos")
    if sk_col is None:
        return tagged.select(*tcols)
    stored = materialize(tagged, "upsert")
    base = "coalesce(max(_m) OVER (), 0)" if start is None else str(int(start))
    # at most 65,536 ranges of 32-bit keys: a bounded window, and a proven bound for the broadcast
    offsets = stored.groupBy(F.col("_bkt").alias("_of")).agg(F.count_if("_new").alias("_n"), F.max(sk_col).alias("_m")).selectExpr(
        "_of", f"{base} + coalesce(sum(_n) OVER (ORDER BY _of NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _off")
    keyed = stored.join(F.broadcast(offsets), stored["_bkt"].eqNullSafe(offsets["_of"]))
    sk = f"CAST(CASE WHEN _new THEN _off + _pos ELSE `{sk_col}` END AS {row.schema[sk_col]}) AS `{sk_col}`"
    return keyed.selectExpr(*[sk if c == sk_col else _name(c) for c in tcols])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], **kw) -> DataFrame:
    """K-04: ``ON CONFLICT DO NOTHING``."""
    return upsert(target, source, keys, update_cols=[], **kw)
