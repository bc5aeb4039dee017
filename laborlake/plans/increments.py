"""Silver, gold and the validation report kept up to date batch by batch (X4, A1-A4, V2-V6), without reading bronze again.

A batch is reduced to one row per content_id: its counters and its first row. Only the keys that it touches are looked
up among the rows held from earlier batches. What is written per batch, each in a folder under its batch id:

* ``firsts``: the batch's first row per key. The smallest over all batches is the key's first row;
* ``support``: signed row counts per (department, region, category, labor_hours). A key that is new adds its row, a key whose
  first row changes takes the old row back. Gold, maxima included, is an aggregate of their sum;
* ``totals``: one row of counters that add up. A key counts as a duplicate if any batch before has it.

A marker file commits a batch; readers see committed batches only, and a batch that failed midway is written anew when it is
added again. One writer at a time; batch ids rise.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.functions.expressions import conform_content, normalize_columns
from laborlake.operators import gold, quality
from laborlake.operators.dedup import first_row_agg, keep_first
from laborlake.operators.quality import ValidationError
from laborlake.operators.silver import group_raw, silver_from_grouped
from laborlake.schemas import BAD_ENCODING, CONTENT_SCHEMA, HOURS_TEXT, REQUIRED_COLUMNS, RULE_COLUMNS
from laborlake.session import create_marker, drop_path, list_names
from laborlake.sinks.lake import Lake

KEY = "content_id"


class Increments:
    """State under ``root`` (a shared folder). ``order``: the columns that tell a key's first row, as ``["ingest_seq"]`` where arrival
    is numbered over all batches, or ``["batch_id", "arrival_pos"]`` where an earlier batch always comes first. Rows that break one
    of the content table's rules are in silver's first rows but not in gold, if ``rules`` is set."""

    def __init__(self, spark: SparkSession, root: str, order: Sequence[str], rules: bool = True):
        self.spark, self.root, self.order, self.rules = spark, root.rstrip("/"), list(order), rules
        self.lake = Lake(spark, self.root)
        self.columns = [f.name for f in CONTENT_SCHEMA.fields] + [HOURS_TEXT] + self.order

    # ---- what is held ------------------------------------------------------------------------

    def batches(self) -> list[int]:
        """Committed batch ids, rising."""
        return [int(n) for n in list_names(self.spark, f"{self.root}/commits") if re.fullmatch(r"[0-9]{18}", n)]

    def _parts(self, kind: str, after: int = -1) -> list[str]:
        """Folders of the committed batches that are still there."""
        there = set(list_names(self.spark, f"{self.root}/{kind}"))
        return [f"{self.root}/{kind}/batch_id={b}" for b in self.batches() if b > after and f"batch_id={b}" in there]

    def _held(self) -> DataFrame | None:
        """First rows of all committed batches, and the compacted ones; a row that is in both does no harm."""
        paths, merged = self._parts("firsts"), self.lake.current("silver", "firsts")
        paths += [merged] if merged else []
        return self.spark.read.parquet(*paths).select(*self.columns) if paths else None

    def firsts(self) -> DataFrame:
        """The first row of every key, as it arrived."""
        held = self._held()
        if held is None:
            raise FileNotFoundError(self.root)
        return keep_first(held, [KEY], self.order)

    def silver(self) -> DataFrame:
        """Silver rows of all batches (the answer of ``silver.build_silver`` over all raw rows)."""
        return self._silver(self.firsts().select(KEY, self._packed()[0].alias("_first"))).drop(*RULE_COLUMNS)

    def support(self) -> DataFrame:
        """Counts per group and labor_hours over all batches."""
        merged = self.lake.current("gold", "support")
        upto, frames = -1, []
        if merged:
            held = self.spark.read.parquet(merged)
            first = held.select("upto").first()
            upto = first["upto"] if first else -1  # an empty version adds nothing, nor do the batches that it sums up
            frames = [held.drop("upto")]
        paths = self._parts("support", upto)
        frames += [self.spark.read.parquet(*paths)] if paths else []
        if not frames:
            raise FileNotFoundError(self.root)
        return gold.merge_support(frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1]))

    def gold(self) -> dict[str, DataFrame]:
        """The frames of ``gold.gold_frames`` over all batches."""
        return gold.gold_frames(gold.state_from_support(self.support()))

    def report(self) -> DataFrame:
        """V2-V6 over all rows of all batches, from one row of counters a batch."""
        paths = self._parts("totals")
        if not paths:
            raise FileNotFoundError(self.root)
        return quality.report_from_totals(self.spark.read.parquet(*paths))

    # ---- one batch ---------------------------------------------------------------------------

    def _packed(self):
        """A row as a struct that compares by arrival, and the order of its fields."""
        names = self.order + [c for c in self.columns if c != KEY and c not in self.order]
        return F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(names)]), names

    def _silver(self, keyed: DataFrame) -> DataFrame:
        return silver_from_grouped(keyed, self._packed()[1], self.columns)

    def _counted(self, keyed: DataFrame, sign: int) -> DataFrame:
        rows = self._silver(keyed)
        if self.rules:
            rows = quality.split_by_rules(rows, [*quality.content_rules(), quality.hours_type_rule()])[0]
        return gold.support(rows, sign)

    def add(self, raw: DataFrame, batch_id: int) -> bool:
        """Add one batch of raw events (columns of CONTENT_SCHEMA and those of ``order``); False if it is committed already.

        An empty batch changes nothing but is committed. Null keys are one group, as everywhere: counted, never in silver.
        Rows marked ``bad_encoding`` are left out; a run quarantines them.
        """
        done = self.batches()
        if batch_id in done:
            return False
        if done and batch_id < done[-1]:
            raise ValueError(f"batch {batch_id} comes after batch {done[-1]}")
        raw = normalize_columns(raw)
        missing = [c for c in REQUIRED_COLUMNS if c not in raw.columns]
        if missing:
            raise ValidationError(f"Validation failed. Missing columns: {missing}")
        if BAD_ENCODING in raw.columns:
            raw = raw.where(~F.col(BAD_ENCODING))
        raw = conform_content(raw.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        absent = [F.lit(None).cast("string").alias(c) for c in self.columns if c not in raw.columns and c not in self.order]
        part = lambda kind: f"{self.root}/{kind}/batch_id={batch_id}"

        # One shuffle of the batch: counters and first row per key.
        grouped, packed, names = group_raw(raw.select("*", *absent).select(*self.columns), self.order)
        fields = {c: F.col(f"_first.f{i}").alias(c) for i, c in enumerate(packed)}
        counters = [c for c in grouped.columns if c not in (KEY, "_first")]
        own = [F.col(KEY), *[fields[c] for c in names if c != KEY], F.struct(*counters).alias("_counters")]
        grouped.select(*own).write.mode("overwrite").parquet(part("firsts"))
        batch = self.spark.read.parquet(part("firsts"))

        # Rows held for the batch's keys; a key has at most one row a batch, so none is hot.
        row, _ = self._packed()
        new = batch.select(KEY, row.alias("row"), F.lit(True).alias("new"), "_counters")
        held = self._held()
        if held is not None:
            keys = batch.select(F.col(KEY).alias("_key"))
            old = held.join(keys, F.col(KEY).eqNullSafe(F.col("_key")), "left_semi")
            none = F.lit(None).cast(new.schema["_counters"].dataType).alias("_counters")
            new = new.unionByName(old.select(KEY, row.alias("row"), F.lit(False).alias("new"), none))
        moved = new.groupBy(KEY).agg(
            F.min("row").alias("after"), F.min(F.when(~F.col("new"), F.col("row"))).alias("before"),
            *[F.sum(f"_counters.{c}").alias(c) for c in counters])
        self.lake.drop_stages(f"batch_{batch_id}")  # of an attempt that failed
        moved = self.lake.stage(moved, f"batch_{batch_id}", "moved")

        changed = moved.where(F.col("before").isNull() | (F.col("before") != F.col("after")))
        parts = [self._counted(changed.select(KEY, F.col("after").alias("_first")), 1),
                 self._counted(changed.where(F.col("before").isNotNull()).select(KEY, F.col("before").alias("_first")), -1)]
        gold.merge_support(parts[0].unionByName(parts[1])).write.mode("overwrite").parquet(part("support"))
        again = moved.agg(F.count_if(F.col("before").isNotNull())).scalar()
        (quality.totals_from_per_key(moved).withColumn("duplicate_count", F.col("duplicate_count") + again)
         .write.mode("overwrite").parquet(part("totals")))
        create_marker(self.spark, f"{self.root}/commits/{batch_id:018d}")
        self.lake.drop_stages(f"batch_{batch_id}")
        return True

    def compact(self) -> None:
        """Publish first rows and support of all committed batches as one version each, then drop the folders that went into them.

        Each version is committed by its own marker. First rows may be in a version and in a batch folder at once; support says up
        to which batch it goes. Frames that were read before are void then.
        """
        done = self.batches()
        if not done:
            return
        self.lake.write_silver(self.firsts(), "firsts", partition_by=())
        self.lake.write_gold(self.support().withColumn("upto", F.lit(done[-1]).cast("bigint")), "support")
        for kind in ("firsts", "support"):
            for b in done:
                drop_path(self.spark, f"{self.root}/{kind}/batch_id={b}")
