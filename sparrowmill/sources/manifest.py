"""Manifests, checksums, bundles and column assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.operators.ordering import number_rows, running
from sparrowmill.session import materialize
from sparrowmill.sources.files import exists, file_listing


def dataset_manifest(df: DataFrame, name: str, index: str, shard: str) -> DataFrame:
    """One row: features, examples, shards, shard names, source index range, order tag, and the same as JSON.

    Shard names are as many as the table has files, not rows.
    """
    features = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields if f.name != shard)
    per_shard = df.groupBy(F.col(shard).alias("_shard")).agg(
        F.count("*").alias("_n"), F.min(index).alias("_lo"), F.max(index).alias("_hi")
    )
    row = per_shard.agg(
        F.sum("_n").alias("num_examples"), F.count("*").alias("num_shards"),
        F.array_sort(F.collect_list("_shard")).alias("shard_names"),
        F.min("_lo").alias("source_index_start"), (F.max("_hi") + 1).alias("source_index_end_exclusive"),
    )
    row = row.select(
        F.lit(name).alias("dataset_name"), F.lit(features).alias("features"), F.lit(f"{index}_ascending").alias("order"), "*"
    )
    return row.withColumn("manifest", F.to_json(F.struct(*row.columns)))


SHARDS = "file string, num_rows bigint, num_bytes bigint, digest bigint, source_index_start bigint, source_index_end_exclusive bigint, dataset string"


def _shard_files(spark: SparkSession, root: str, index: str | None) -> DataFrame:
    """One row per data file: name below the root, rows, bytes, digest of the rows, range of the index."""
    below = lambda path: F.regexp_extract(path, "/(data/.*)$", 1)
    data = spark.read.parquet(f"{root}/data")
    lo, hi = (F.min(index), F.max(index) + 1) if index else (F.lit(None), F.lit(None))
    hashed = F.pmod(F.xxhash64(*sorted(data.columns)), F.lit(1 << 40))
    rows = data.groupBy(below("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("num_rows"), F.sum(hashed).alias("digest"),
        lo.cast("bigint").alias("source_index_start"), hi.cast("bigint").alias("source_index_end_exclusive"),
    )
    files = file_listing(spark, f"{root}/data").filter(F.col("name").endswith(".parquet"))
    sizes = files.select(below("path").alias("file"), F.col("length").alias("num_bytes"))
    return sizes.join(rows, "file", "left")


def commit_manifest(spark: SparkSession, root: str, name: str, index: str = "source_index") -> None:
    """Write root/dataset_infos, the last step of writing a dataset: what is not listed there was not committed.

    JSON, one line per shard file, each with the description of the whole dataset. A second commit is refused.
    """
    shards = materialize(_shard_files(spark, root, index))
    features = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in spark.read.parquet(f"{root}/data").schema.fields)
    whole = shards.agg(
        F.struct(
            F.lit(name).alias("dataset_name"), F.lit(features).alias("features"), F.lit(f"{index}_ascending").alias("order"),
            F.sum("num_rows").alias("num_examples"), F.count("*").alias("num_shards"),
        )
    ).scalar()
    shards.withColumn("dataset", F.to_json(whole)).write.mode("errorifexists").json(f"{root}/dataset_infos")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The listed shards; a dataset without a committed manifest is an error."""
    if not exists(spark, f"{root}/dataset_infos", "*.json"):
        raise FileNotFoundError(f"{root} has no committed manifest")
    return spark.read.schema(SHARDS).json(f"{root}/dataset_infos")


def check_dataset(spark: SparkSession, root: str, index: str = "source_index") -> DataFrame:
    """(file, state, num_rows): ok, changed (bytes, rows or their digest differ), missing, or unlisted files."""
    want = read_manifest(spark, root).select("file", *[F.col(c).alias(f"_{c}") for c in ("num_rows", "num_bytes", "digest")])
    both = _shard_files(spark, root, index).join(want, "file", "full")
    same = F.lit(True)
    for c in ("num_rows", "num_bytes", "digest"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    state = F.when(F.col("num_bytes").isNull(), "missing").when(F.col("_num_bytes").isNull(), "unlisted").when(same, "ok").otherwise("changed")
    return both.select("file", state.alias("state"), F.coalesce("num_rows", "_num_rows").alias("num_rows"))


def read_dataset(spark: SparkSession, root: str, index: str = "source_index") -> DataFrame:
    """The rows of the listed files, after a check that none is missing or changed. Other files do not count."""
    bad = check_dataset(spark, root, index).filter("state in ('missing', 'changed')").orderBy("file").limit(10).collect()
    if bad:
        raise ValueError(", ".join(f"{r['file']} is {r['state']}" for r in bad))
    data = spark.read.parquet(f"{root}/data")
    listed = read_manifest(spark, root).select(F.col("file").alias("_file"))
    mine = F.regexp_extract("_metadata.file_path", "/(data/.*)$", 1)
    return data.withColumn("_file", mine).join(listed, "_file", "left_semi").drop("_file")


def checksums(df: DataFrame, key: str, content: str) -> DataFrame:
    return df.select(key, F.sha1(F.col(content).cast("binary")).alias("sha1"))


def verify_checksums(df: DataFrame, manifest: DataFrame, key: str, content: str) -> DataFrame:
    """(key, state): ok, changed, missing (only in the manifest) or unlisted (only in the data)."""
    have = checksums(df, key, content)
    want = manifest.select(F.col(key).alias("_k"), F.col("sha1").alias("_want"))
    both = have.join(want, F.col(key) == F.col("_k"), "full")
    state = (
        F.when(F.col(key).isNull(), "missing").when(F.col("_k").isNull(), "unlisted")
        .when(F.col("sha1") == F.col("_want"), "ok").otherwise("changed")
    )
    return both.select(F.coalesce(key, "_k").alias(key), state.alias("state"))


def assemble(columns: dict[str, tuple[DataFrame, list]]) -> DataFrame:
    """Rows from parallel columns by position: each frame holds one value column and an order.

    A column that ends early is null from there on; no row of a longer one is lost.
    """
    parts = [
        number_rows(df.select(*dict.fromkeys([name, *order])), *order, name="source_index").select("source_index", name)
        for name, (df, order) in columns.items()
    ]
    return reduce(lambda a, b: a.join(b, "source_index", "full"), parts)


def group_by_length(fields: DataFrame) -> DataFrame:
    """(length, fields): metadata fields of equal length share a table; length 0 is skipped."""
    kept = fields.filter("length > 0")
    return kept.groupBy("length").agg(F.array_sort(F.collect_list("field")).alias("fields"))


def write_length_tables(fields: dict[str, tuple[DataFrame, list]], root: str) -> DataFrame:
    """Write fields of equal length side by side, by position, to root/meta/meta_l<length>; lists (length, fields).

    Each field is a frame with a column of its name and an order. Fields without rows are skipped.
    """
    spark = next(iter(fields.values()))[0].sparkSession
    counts = [df.agg(F.count("*").alias("length")).select(F.lit(name).alias("field"), "length") for name, (df, _) in fields.items()]
    groups = group_by_length(reduce(DataFrame.unionByName, counts)).collect()  # one row per length, no more than fields
    for length, names in groups:
        table = assemble({n: fields[n] for n in names})
        table.write.mode("errorifexists").parquet(f"{root}/meta/meta_l{length}")
    return spark.createDataFrame(sorted(map(tuple, groups)), "length bigint, fields array<string>")


def length_tables(spark: SparkSession, root: str) -> DataFrame:
    """(length, num_files, total_size) of the metadata tables below root/meta, from the listing alone."""
    files = file_listing(spark, f"{root}/meta").filter(F.col("name").endswith(".parquet"))
    length = F.regexp_extract("folder", "^meta_l([0-9]+)$", 1)
    known = files.select(F.when(length != "", length.cast("bigint")).alias("rows"), F.col("length").alias("size")).filter("rows is not null")
    return known.groupBy(F.col("rows").alias("length")).agg(F.count("*").alias("num_files"), F.sum("size").alias("total_size"))


def bundle_manifest(files: DataFrame, folder: str, name: str, size: Column, max_bytes: int) -> DataFrame:
    """Per folder: files in name order with a bundle number.

    A file goes to bundle floor(bytes before it / max_bytes), so a bundle holds at most max_bytes plus
    its last file. Folders without files have no rows and thus no bundle.
    """
    sized = files.withColumn("_size", size)
    run = running(sized, [folder], [name], {"_before": ("sum_before", F.col("_size"))})
    bundle = F.floor(F.coalesce("_before", F.lit(0)) / max_bytes)
    return run.withColumn("bundle", bundle).drop("_before").withColumnRenamed("_size", "size")
