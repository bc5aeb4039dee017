"""Medallion lake on a shared file system: ``<root>/<layer>/<dataset>/`` parquet datasets.

``root`` defaults to ``<spark.checkpoint.dir>/lake`` (the cluster's shared
folder). Bronze is append-only and partitioned by run id (a re-run never
overwrites an earlier run). Silver and gold are published as versions: a write fills a folder of its own, and one marker
file in it commits it. Readers resolve the newest committed version once, so a write that fails midway leaves
the old answer, and a plan that has begun to read one keeps it through the next publication.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from laborlake.session import create_marker, drop_path, list_names, path_exists, scratch_root, small_splits

LAYERS = ["bronze", "silver", "gold"]

# Bound on rows per output file, so one hot partition value still yields many moderate files.
MAX_RECORDS_PER_FILE = 5_000_000
COMPRESSION = "zstd"  # a fifth to a half smaller than Spark's default, for the same time

# A committed version holds this file (a name that Spark's listings leave out); so many committed versions stay.
COMMITTED = "_COMMITTED"
VERSIONS_KEPT = 2


def new_run_id(now: _dt.datetime | None = None) -> str:
    """``RUN_%Y%m%d_%H%M%S`` plus a short unique suffix (same-second runs stay apart)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("RUN_%Y%m%d_%H%M%S") + "_" + uuid.uuid4().hex[:6]


class Lake:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{scratch_root(spark)}/lake").rstrip("/")

    def path(self, layer: str, dataset: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{self.root}/{layer}/{dataset}"

    # ---- writes ----------------------------------------------------------------------------

    def write_bronze(self, df: DataFrame, dataset: str, run_id: str | None = None,
                     source_system: str | None = None) -> str:
        """K4: unmodified rows + source_system, ingested_at; appended under ingest_run_id=<run>."""
        run_id = run_id or new_run_id()
        out = df
        if "source_system" not in out.columns:
            out = out.withColumn("source_system", F.lit(source_system).cast("string"))
        out = (out.withColumn("ingested_at", F.current_timestamp())
               .withColumn("ingest_run_id", F.lit(run_id)))
        path = self.path("bronze", dataset)
        (out.write.mode("append").partitionBy("ingest_run_id")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", COMPRESSION).parquet(path))
        return path

    def read_bronze(self, dataset: str, run_id: str | None = None) -> DataFrame:
        """The rows of one run, with that run's own columns; without a run all rows, columns merged by name."""
        path = self.path("bronze", dataset)
        if run_id is not None:
            return self.spark.read.parquet(f"{path}/ingest_run_id={run_id}")
        return self.spark.read.option("mergeSchema", True).parquet(path)

    def stage(self, df: DataFrame, run_id: str, name: str) -> DataFrame:
        """Write an intermediate frame of a run (columnar, prunable) and read it back."""
        path = f"{self.root}/_staging/{run_id}/{name}"
        with small_splits(self.spark):
            df.write.option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_stages(self, run_id: str) -> None:
        drop_path(self.spark, f"{self.root}/_staging/{run_id}")

    def versions(self, layer: str, dataset: str) -> list[str]:
        """Committed versions, oldest first."""
        path = self.path(layer, dataset)
        return [n for n in list_names(self.spark, path) if n.startswith("v") and path_exists(self.spark, f"{path}/{n}/{COMMITTED}")]

    def current(self, layer: str, dataset: str) -> str | None:
        """Folder of the newest committed version; None if nothing was published."""
        held = self.versions(layer, dataset)
        return f"{self.path(layer, dataset)}/{held[-1]}" if held else None

    def _publish(self, df: DataFrame, layer: str, dataset: str, partition_by: tuple[str, ...] = ()) -> str:
        path = self.path(layer, dataset)
        names = [n for n in list_names(self.spark, path) if n.startswith("v")]
        number = int(names[-1][1:13]) + 1 if names else 1
        out = f"{path}/v{number:012d}_{uuid.uuid4().hex[:6]}"
        w = df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", COMPRESSION)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(out)
        create_marker(self.spark, f"{out}/{COMMITTED}")
        kept = self.versions(layer, dataset)[-VERSIONS_KEPT:]
        for name in names:  # older ones, and what failed writes left before this one began
            if name not in kept:
                drop_path(self.spark, f"{path}/{name}")
        return out

    def write_silver(self, df: DataFrame, dataset: str, partition_by: tuple[str, ...] = ("region",),
                     dynamic: bool = False) -> str:
        """K1/K5: publish a new version, partitioned by region; its folder.

        No ``repartition(region)``: with a handful of regions that would leave a
        handful of writer tasks for the whole table. Each task writes at most one
        file per region it holds (the writer sorts by the partition column), and
        ``maxRecordsPerFile`` bounds file size. ``dynamic`` replaces only the
        partitions present in ``df``: the others are carried over from the version before.
        """
        if dynamic and partition_by and self.current("silver", dataset) is not None:
            old = self.read_layer("silver", dataset)
            new = df.select(*[F.col(c).alias(f"_{c}") for c in partition_by]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by])
            df = df.unionByName(old.join(new, same, "left_anti"), allowMissingColumns=True)
        return self._publish(df, "silver", dataset, partition_by)

    def write_gold(self, df: DataFrame, dataset: str) -> str:
        """K2/K5: publish a new version, unpartitioned (gold frames are small aggregates); its folder."""
        return self._publish(df, "gold", dataset)

    # ---- reads -----------------------------------------------------------------------------

    def read_layer(self, layer: str, dataset: str) -> DataFrame:
        """Read a dataset (silver and gold: its current version); a missing one raises FileNotFoundError."""
        path = self.path(layer, dataset)
        if layer != "bronze":
            current = self.current(layer, dataset)
            if current is None:
                raise FileNotFoundError(path)
            return self.spark.read.parquet(current)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                raise FileNotFoundError(str(e)) from e
            raise

    def files(self) -> DataFrame:
        """One row per data file of bronze and of the current versions: layer, dataset, file_path, bytes (content is never read)."""
        listing = (self.spark.read.format("binaryFile")
                   .option("recursiveFileLookup", "true")
                   .option("pathGlobFilter", "*.parquet")
                   .load(self.root)
                   .select("path", "length"))
        # The last such folder in the path: the root itself may hold one of the names.
        pattern = r"^.*/(bronze|silver|gold)/([^/]+)/(v[0-9]{12}_[0-9a-f]{6}/)?"
        current = [self.current(layer, name) for layer in LAYERS[1:] for name in list_names(self.spark, f"{self.root}/{layer}")]
        version = F.rtrim(F.regexp_extract("path", pattern, 3), F.lit("/"))
        held = (version == "") | version.isin([path.rsplit("/", 1)[1] for path in current if path])
        return listing.where(held).select(
            F.regexp_extract("path", pattern, 1).alias("layer"),
            F.regexp_extract("path", pattern, 2).alias("dataset"),
            F.col("path").alias("file_path"),
            F.col("length").alias("bytes"),
        )

    def inventory(self) -> DataFrame:
        """File count and bytes per (layer, dataset); one aggregate over the file listing."""
        return (self.files().groupBy("layer", "dataset")
                .agg(F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes")))

    def storage_summary(self) -> DataFrame:
        """Per layer: datasets, files and bytes."""
        return (self.files().groupBy("layer")
                .agg(F.countDistinct("dataset").alias("dataset_count"),
                     F.count(F.lit(1)).alias("file_count"),
                     F.sum("bytes").alias("total_bytes")))

    def row_counts(self) -> DataFrame:
        """Rows per (layer, dataset), from the Parquet footers; one branch per dataset."""
        names = sorted((r["layer"], r["dataset"]) for r in self.inventory().select("layer", "dataset").collect())
        counts = [self.read_layer(layer, dataset).agg(F.count(F.lit(1)).alias("row_count"))
                  .select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "row_count") for layer, dataset in names]
        return reduce(DataFrame.unionByName, counts)


def write_csv(df: DataFrame, path: str) -> str:
    """K3: CSV with header, quotes doubled, overwrite (a directory of part files; no single-file coalesce)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
