"""Schema contracts, profiles, reconciliation, names, distribution tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.functions.rand import portable_rand
from sparrowmill.functions.text import two_decimals
from sparrowmill.operators.ordering import number_rows, position_in_key
from sparrowmill.session import materialize



def check_fields(df: DataFrame, required: list[str]) -> DataFrame:
    """(field, present, filled): whether each required field exists and in how many rows it has a value."""
    have = set(df.columns)
    cells = [
        F.struct(F.lit(f).alias("field"), F.lit(f in have).alias("present"),
                 (F.count(f) if f in have else F.lit(0).cast("bigint")).alias("filled"))
        for f in required
    ]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


# fixed values: logical field types and the stored type; int8 is stored as a 32-bit integer
PHYSICAL = {
    "image": "struct<bytes:binary,path:string>", "string": "string", "int8": "int", "int32": "int",
    "int64": "bigint", "float32": "float", "float32_2": "array<float>", "float32_3": "array<float>", "int32_2": "array<int>",
    "int32_3": "array<int>",
}


def build_schema(fields: dict[str, str]) -> T.StructType:
    """Spark schema of logical field types; an unknown type is an error."""
    out = T.StructType()
    for name, kind in fields.items():
        if kind not in PHYSICAL:
            raise ValueError(f"unknown type {kind!r} of field {name!r}")
        out = out.add(name, T.DataType.fromDDL(PHYSICAL[kind]))
    return out


def apply_schema(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Cast to the stored types; a fixed-length array of another length fails the job."""
    schema = build_schema(fields)
    cols = []
    for f in schema.fields:
        col = F.col(f.name).cast(f.dataType)
        length = fields[f.name].rpartition("_")[2]
        if fields[f.name].count("_") and length.isdigit():
            wrong = F.concat(F.lit(f"{f.name} must have {length} elements, has "), F.size(f.name).cast("string"))
            col = F.when(F.size(f.name) == int(length), col).otherwise(F.raise_error(wrong).cast(f.dataType))
        cols.append(col.alias(f.name))
    return df.select(*cols)


def sample_text(df: DataFrame, column: str) -> Column:
    """A value as shown in a profile: text cut at 50, arrays at 5 items, floats with 2 decimals."""
    kind = df.schema[column].dataType
    value = F.col(column)
    number = lambda x: two_decimals(x.cast("double"))
    if isinstance(kind, T.StringType):
        return F.when(F.length(value) > 50, F.concat(F.left(value, F.lit(50)), F.lit("..."))).otherwise(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return number(value)
    if isinstance(kind, T.ArrayType):
        floats = isinstance(kind.elementType, (T.FloatType, T.DoubleType))
        shown = F.transform(F.slice(value, 1, 5), number) if floats else F.slice(value, 1, 5).cast("array<string>")
        return F.concat(F.array_join(shown, ", "), F.when(F.size(value) > 5, ", ...").otherwise(""))
    return value.cast("string")


def profile(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """(field, dtype, rows, filled, samples): per column the values of the n first rows by key."""
    head = df.orderBy(key).limit(n)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    pairs = [
        F.struct(
            F.lit(c).alias("field"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"), sample_text(df, c).alias("v")
        )
        for c in df.columns
    ]
    # n rows per column: the sample is tiny whatever the table
    long = head.select(F.col(key).alias("_k"), F.inline(F.array(*pairs)))
    samples = long.groupBy("field", "dtype").agg(F.array_sort(F.collect_list(F.struct("_k", "v"))).alias("_s"))
    filled = counts.select("_rows", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in df.columns])))
    out = samples.join(filled, "field")
    return out.select("field", "dtype", F.col("_rows").alias("rows"), "filled", F.transform("_s", lambda s: s["v"]).alias("samples"))


def record_view(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows in long form (key, field, value); values longer than 80 are cut."""
    rest = [c for c in df.columns if c != key]
    rows = df.orderBy(key).limit(n).select(key, *[F.col(c).cast("string").alias(c) for c in rest])
    long = rows.unpivot(key, rest, "field", "value")
    return long.withColumn("value", F.when(F.length("value") > 80, F.concat(F.left("value", F.lit(80)), F.lit("..."))).otherwise(F.col("value")))


# fixed values: first bytes of common payloads, as hex
MAGIC = {"FFD8FF": "jpeg_bytes", "89504E47": "png_bytes", "3C21444F": "html_text", "7B": "json_text"}


def payload_kind(raw: Column) -> Column:
    """Kind of a binary payload by its first bytes; anything else is `unknown`."""
    head = F.hex(F.substring(raw, 1, 4))
    out = F.lit("unknown")
    for magic, kind in MAGIC.items():
        out = F.when(head.startswith(magic), F.lit(kind)).otherwise(out)
    return F.when(raw.isNull(), F.lit("missing")).otherwise(out)


def payload_field(df: DataFrame, column: str) -> str:
    """How a column stores its payload: raw bytes, the field of a struct, or an array. Others are refused."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BinaryType):
        return "bytes"
    if isinstance(kind, T.ArrayType):
        return "array"
    if isinstance(kind, T.StructType):
        for name in ("bytes", "uri", "encoded", "data"):
            if name in kind.names:
                return f"struct.{name}"
    raise ValueError(f"{column}: {kind.simpleString()} holds no known payload")


def payload(df: DataFrame, column: str) -> Column:
    """The payload of a column, where payload_field finds it."""
    field = payload_field(df, column)
    return F.col(column)[field.removeprefix("struct.")] if field.startswith("struct.") else F.col(column)


def preview(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(portable_rand(key, seed=seed), key).limit(n)


def reconcile(a: DataFrame, b: DataFrame, key: str, discrete, arrays, atol: float = 1e-6) -> DataFrame:
    """One row: rows on each side, keys on one side only, differing discrete values, arrays beyond atol.

    All rows are compared, by key.
    """
    left = a.select(F.col(key).alias("_k"), F.struct(*discrete, *arrays).alias("_a"))
    right = b.select(F.col(key).alias("_kb"), F.struct(*discrete, *arrays).alias("_b"))
    both = left.join(right, F.col("_k") == F.col("_kb"), "full")
    matched = F.col("_k").isNotNull() & F.col("_kb").isNotNull()
    hit = lambda c: F.sum(F.when(c, 1).otherwise(0))
    differ = F.lit(False)
    for c in discrete:
        differ = differ | ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))
    far = F.lit(False)
    for c in arrays:
        gaps = F.zip_with(f"_a.{c}", f"_b.{c}", lambda x, y: F.abs(x.cast("double") - y.cast("double")))
        far = far | F.coalesce(F.array_max(gaps) > atol, F.lit(False)) | ~F.size(f"_a.{c}").eqNullSafe(F.size(f"_b.{c}"))
    return both.agg(
        F.count("_k").alias("rows_a"), F.count("_kb").alias("rows_b"),
        hit(F.col("_kb").isNull()).alias("only_a"), hit(F.col("_k").isNull()).alias("only_b"),
        hit(matched & differ).alias("discrete_diff"), hit(matched & far).alias("array_diff"),
    )


def same_order(a: DataFrame, b: DataFrame, order_a, order_b, key: str) -> DataFrame:
    """One row: positions at which the two sides hold different keys."""
    left = number_rows(a.select(*dict.fromkeys([key, *order_a])), *order_a, name="_i").select("_i", F.col(key).alias("_a"))
    right = number_rows(b.select(*dict.fromkeys([key, *order_b])), *order_b, name="_i").select("_i", F.col(key).alias("_b"))
    moved = F.sum(F.when(F.col("_a").eqNullSafe(F.col("_b")), 0).otherwise(1))
    return left.join(right, "_i", "full").agg(moved.alias("moved"))


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields as columns with dotted names, at any depth."""
    def leaves(kind, path):
        for f in kind.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, [*path, f.name])
            else:
                yield [*path, f.name]

    quoted = lambda p: ".".join(f"`{x}`" for x in p)
    return df.select(*[F.col(quoted(p)).alias(".".join(p)) for p in leaves(df.schema, [])])


def dedupe_names(df: DataFrame, name: str, order) -> DataFrame:
    """The first row keeps its name, later rows with that name get _1, _2, ..."""
    placed = position_in_key(df, [name], order, "_p")
    fresh = F.when(F.col("_p") > 1, F.concat(F.col(name), F.lit("_"), (F.col("_p") - 1).cast("string"))).otherwise(F.col(name))
    return placed.withColumn("unique_name", fresh).drop("_p")


def rename(df: DataFrame, field_map: dict[str, str], wanted: list[str]) -> DataFrame:
    """Rename through the map and keep the wanted fields that exist; others are dropped."""
    named = df.withColumnsRenamed(field_map)
    return named.select(*[c for c in wanted if c in named.columns])


def label_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """(label, index): distinct labels in order, numbered from 0."""
    return number_rows(df.select(F.col(column).alias("label")).filter("label is not null").distinct(), "label", name=name)


def decode_label(df: DataFrame, index: str, labels: DataFrame) -> DataFrame:
    dim = labels.select(F.col("index").alias(index), "label")
    return df.join(dim, index, "left")


def crosstab(df: DataFrame, row: str, col: str, page: int) -> DataFrame:
    """Two-way counts in pages of `page` columns: (row, page, header, c0, c1, ...).

    Column labels are numbered in order, a null label, called `null`, last; each row of the table is on every
    page. Only counts travel: there is no pivot over the labels, and their number has no bound.
    """
    counts = materialize(df.groupBy(F.col(row).alias("_row"), F.col(col).alias("_col")).agg(F.count("*").alias("n")))
    labels = number_rows(counts.select("_col").distinct(), F.col("_col").asc_nulls_last(), name="_i")
    labels = materialize(labels.select("_col", F.floor(F.col("_i") / page).cast("int").alias("page"), (F.col("_i") % page).cast("int").alias("_slot")))
    named = F.struct("_slot", F.coalesce(F.col("_col").cast("string"), F.lit("null")).alias("name"))
    heads = labels.groupBy("page").agg(F.array_sort(F.collect_list(named)).alias("_h"))  # `page` labels each
    pages = labels.agg(F.coalesce(F.max("page"), F.lit(-1))).scalar()
    same = counts["_col"].eqNullSafe(labels["_col"])
    cells = counts.join(labels, same).groupBy("_row", "page").agg(F.map_from_entries(F.collect_list(F.struct("_slot", "n"))).alias("_n"))
    every = counts.select("_row").distinct().withColumn("_pages", pages).filter("_pages >= 0")
    grid = every.select("_row", F.explode(F.sequence(F.lit(0), "_pages")).alias("page"))
    at = [grid["page"] == cells["page"], grid["_row"].eqNullSafe(cells["_row"])]
    filled = grid.join(cells, at, "left").select(grid["_row"], grid["page"], "_n").join(heads, "page")
    value = lambda j: F.when(F.size("_h") > j, F.coalesce(F.try_element_at("_n", F.lit(j)), F.lit(0).cast("bigint")))
    header = F.array_join(F.transform("_h", lambda h: h["name"]), ",").alias("header")
    return filled.select(F.col("_row").alias(row), "page", header, *[value(j).alias(f"c{j}") for j in range(page)])
