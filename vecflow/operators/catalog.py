"""Deriving a target collection's settings from what the source says about itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.schema import FIELDS, UNNAMED
from vecflow.sources.relational import is_vector_type

# Metric names of each source and the distance they stand for.
DISTANCES = ("euclid", "cosine", "dot", "manhattan")
ES_SIMILARITY = {
    "l2_norm": "euclid",
    "cosine": "cosine",
    "dot_product": "dot",
    "max_inner_product": "dot",
}
OS_SPACE_TYPE = {
    "l2": "euclid",
    "cosinesimil": "cosine",
    "innerproduct": "dot",
    "l1": "manhattan",
}
PINECONE_METRIC = {"cosine": "cosine", "euclidean": "euclid", "dotproduct": "dot"}
S3_METRIC = {"cosine": "cosine", "euclidean": "euclid"}
OWN_METRIC = {"euclid": "euclid", "cosine": "cosine", "dot": "dot", "manhattan": "manhattan"}
PINECONE_VECTOR_TYPES = ("dense", "sparse")
SINGLE_VECTOR_METRICS = {
    "pinecone": PINECONE_METRIC,
    "s3_vectors": S3_METRIC,
    "chroma": OWN_METRIC,
    "faiss": OWN_METRIC,
}
DEFAULT_METRIC = {"chroma": "euclid", "faiss": "cosine"}
PAYLOAD_TYPES = ("keyword", "integer", "float", "geo", "text", "bool", "datetime", "uuid")
CUSTOM_SHARDING = "custom"


def lookup(table: Mapping[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for entry in table.items() for x in entry])[key]


def _stop(message: Column, data_type: str) -> Column:
    return F.raise_error(message).cast(data_type)


def discover_vector_columns(df: DataFrame) -> DataFrame:
    """Vector columns and their one dimension, found in a single aggregate pass.

    A column whose rows differ in length, or that has none, stops the job.
    """
    names = [f.name for f in df.schema if is_vector_type(f.dataType)]
    if not names:
        return df.sparkSession.createDataFrame([], "name string, dimension bigint")
    sizes = [F.when(F.col(n).isNotNull(), F.size(n)) for n in names]
    extremes = df.agg(
        *[F.min(size).alias(f"min_{i}") for i, size in enumerate(sizes)],
        *[F.max(size).alias(f"max_{i}") for i, size in enumerate(sizes)],
    )
    entries = []
    for i, name in enumerate(names):
        low, high = F.col(f"min_{i}"), F.col(f"max_{i}")
        dimension = F.when((low > 0) & (low == high), low.cast("bigint")).otherwise(
            _stop(F.lit(f"vector column {name} has no single positive dimension"), "bigint")
        )
        entries.append(F.struct(F.lit(name).alias("name"), dimension.alias("dimension")))
    return extremes.select(F.inline(F.array(*entries)))


def _mapping_params(
    mappings: DataFrame, column: str, field_type: str, dims: str, metric: str, table: dict[str, str]
) -> DataFrame:
    data_type = mappings.schema[column].dataType
    document = F.col(column) if isinstance(data_type, T.VariantType) else F.parse_json(column)
    indexes = mappings.select(
        F.explode(F.variant_get(document, "$", FIELDS)).alias("collection", "_index")
    )
    properties = F.try_variant_get("_index", "$.mappings.properties", FIELDS)
    broken = F.concat(F.lit("no field properties in the mapping of index "), F.col("collection"))
    fields = indexes.select(
        "collection", F.explode(F.coalesce(properties, _stop(broken, FIELDS))).alias("name", "_def")
    )
    kind = F.try_variant_get("_def", "$.type", "string")
    size = F.try_variant_get("_def", f"$.{dims}", "variant")
    declared = F.lower(F.try_variant_get("_def", f"$.{metric}", "string"))
    number = F.when(
        F.schema_of_variant(size).rlike(r"^(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))$"),
        F.try_variant_get(size, "$", "double").cast("bigint"),
    ).otherwise(_stop(F.concat(F.lit("the number of dimensions is not a number: field "), F.col("name")), "bigint"))
    known = lookup(table, declared)
    return fields.where((kind == field_type) & size.isNotNull()).select(
        "collection",
        "name",
        number.alias("size"),
        F.coalesce(known, F.lit("cosine")).alias("distance"),
        known.isNull().alias("defaulted"),
    )


def params_from_es_mapping(mappings: DataFrame, column: str = "mapping") -> DataFrame:
    """``dense_vector`` fields of index mappings; unknown similarity falls back to cosine."""
    return _mapping_params(mappings, column, "dense_vector", "dims", "similarity", ES_SIMILARITY)


def params_from_os_mapping(mappings: DataFrame, column: str = "mapping") -> DataFrame:
    """``knn_vector`` fields of index mappings; unknown space type falls back to cosine."""
    return _mapping_params(
        mappings, column, "knn_vector", "dimension", "space_type", OS_SPACE_TYPE
    )


def check_distances(overrides: Mapping[str, str]) -> None:
    for name, distance in overrides.items():
        if distance not in DISTANCES:
            raise ValueError(f"vector {name!r} cannot be compared by {distance!r}")


def params_from_fields(
    fields: DataFrame, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Float-vector fields of ``(collection, name, data_type, type_params)`` rows.

    The dimension comes from ``type_params['dim']``; the distance is the field's
    override or cosine.
    """
    overrides = dict(overrides or {})
    check_distances(overrides)
    dim = F.col("type_params")["dim"]
    size = F.when(dim.rlike(r"^[0-9]+\z"), dim.try_cast("bigint"))
    size = F.coalesce(
        size, _stop(F.concat(F.lit("no whole number of dimensions for field "), F.col("name")), "bigint")
    )
    chosen = lookup(overrides, F.col("name")) if overrides else F.lit(None).cast("string")
    return fields.where(F.col("data_type") == "FloatVector").select(
        "collection", "name", size.alias("size"), F.coalesce(chosen, F.lit("cosine")).alias("distance")
    )


def distance_of(source: Column, metric: Column) -> Column:
    """The distance a single-vector source's metric name stands for, null if unknown."""
    pairs = {f"{s}:{m}": d for s, t in SINGLE_VECTOR_METRICS.items() for m, d in t.items()}
    named = F.coalesce(metric, lookup(DEFAULT_METRIC, source))
    return lookup(pairs, F.concat(source, F.lit(":"), named))


def params_single(indexes: DataFrame, strict: bool = True) -> DataFrame:
    """One unnamed vector per ``(collection, source, metric, size[, vector_type])`` row.

    ``strict`` stops at an unknown metric of S3 vectors and at a Pinecone vector
    type other than dense or sparse; a sparse index has a sparse vector only.
    """
    source = F.col("source")
    distance = distance_of(source, F.col("metric"))
    vector_type = (
        F.coalesce("vector_type", F.lit("dense")) if "vector_type" in indexes.columns else F.lit("dense")
    )
    problem = F.when(
        (source == "s3_vectors") & distance.isNull(),
        F.concat(F.lit("no counterpart for the distance "), F.coalesce("metric", F.lit("none"))),
    ).when(
        (source == "pinecone") & ~vector_type.isin(*PINECONE_VECTOR_TYPES),
        F.concat(F.lit("neither a dense nor a sparse index: "), vector_type),
    )
    distance = F.when(vector_type == "dense", distance)
    if strict:
        distance = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(distance)
    return indexes.select(
        "collection",
        "source",
        F.lit(UNNAMED).alias("name"),
        vector_type.alias("vector_type"),
        F.when(vector_type == "dense", F.col("size")).alias("size"),
        distance.alias("distance"),
        problem.alias("problem"),
    )


def payload_field_type(data_type: Column) -> Column:
    """The index type of a payload field; null for a type that has none."""
    return F.when(data_type.isin(*PAYLOAD_TYPES), data_type)


def payload_index_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """Payload fields with a known type that the same-named target collection lacks."""

    def fields(catalog: DataFrame) -> DataFrame:
        return catalog.select("name", F.explode("payload_schema").alias("field", "_type"))

    wanted = fields(source).withColumn("field_type", payload_field_type(F.col("_type")))
    return (
        wanted.where(F.col("field_type").isNotNull())
        .join(fields(target).select("name", "field"), ["name", "field"], "left_anti")
        .select("name", "field", "field_type")
    )


def clone_spec(source: DataFrame, target_name: Column, routed: bool = False) -> DataFrame:
    """Copy a collection's settings; routed writes need custom sharding."""
    method = F.lit(CUSTOM_SHARDING) if routed else F.col("sharding_method")
    return source.select(
        target_name.alias("name"),
        "vectors",
        "sparse_names",
        F.create_map().cast("map<string,string>").alias("payload_schema"),
        method.alias("sharding_method"),
    )


def ensure_collections(catalog: DataFrame, wanted: DataFrame, mode: str = "create") -> DataFrame:
    """The catalog after preparing the ``wanted`` collections.

    ``create`` adds missing ones and leaves existing ones alone, ``skip`` adds
    none, ``require`` stops the job at one that is missing.
    """
    missing = wanted.join(catalog.select("name"), "name", "left_anti").select(*catalog.columns)
    if mode == "create":
        return catalog.unionByName(missing)
    if mode == "skip":
        return catalog
    if mode == "require":
        stop = F.concat(F.lit("collection does not exist: "), F.col("name"))
        return catalog.unionByName(missing.withColumn("name", F.raise_error(stop)))
    raise ValueError(f"mode must be create, skip or require, not {mode!r}")


def check_dimensions(points: DataFrame, spec: DataFrame, collection: str = "name") -> DataFrame:
    """Vector names and sizes found in ``points`` that ``spec`` does not declare.

    Dense vectors and the parts of multi vectors need the size in ``vectors``;
    sparse ones have none and need their name in ``sparse_names``. ``points`` and
    ``spec`` share the ``collection`` column. Sizes are counted in one pass before
    anything is compared, so only distinct ones are shuffled.
    """
    use = "array<struct<vector:string,_sparse:boolean,found_size:bigint>>"

    def entry(name: Column, size: Column | None) -> Column:
        return F.struct(name, F.lit(size is None), F.lit(None) if size is None else size)

    uses = {
        "dense": lambda e: F.array(entry(e["key"], F.size(e["value"]))),
        "multi": lambda e: F.transform(
            F.array_distinct(F.transform(e["value"], lambda part: F.size(part))),
            lambda size: entry(e["key"], size),
        ),
        "sparse": lambda e: F.array(entry(e["key"], None)),
    }
    present = [
        F.coalesce(F.flatten(F.transform(F.map_entries(kind), of)).cast(use), F.array().cast(use))
        for kind, of in uses.items()
        if kind in points.columns
    ]
    found = (
        points.select(collection, F.inline(F.concat(*present)))
        .groupBy(collection, "vector", "_sparse", "found_size")
        .agg(F.count(F.lit(1)).alias("points"))
    )
    sized = spec.select(collection, F.explode("vectors").alias("vector", "_params"))
    declared = sized.select(
        collection, "vector", F.lit(False).alias("_sparse"), F.col("_params.size").alias("declared_size")
    )
    if "sparse_names" in spec.columns:
        names = spec.select(collection, F.explode("sparse_names").alias("vector"))
        declared = declared.unionByName(
            names.select("*", F.lit(True).alias("_sparse"), F.lit(None).cast("bigint").alias("declared_size"))
        )
    declared = declared.withColumn("_declared", F.lit(True))
    same_size = F.col("declared_size").eqNullSafe(F.col("found_size"))
    return (
        found.join(declared, [collection, "vector", "_sparse"], "left")
        .where(F.col("_declared").isNull() | ~same_size)
        .drop("_sparse", "_declared")
    )


def check_routable(spec: DataFrame) -> DataFrame:
    """Stop unless every target of a routed write uses custom sharding."""
    custom = F.coalesce(F.col("sharding_method") == CUSTOM_SHARDING, F.lit(False))
    message = F.concat(
        F.lit("target collection "),
        F.col("name"),
        F.lit(" takes no shard keys: its sharding is not custom"),
    )
    return spec.where(F.when(custom, F.lit(True)).otherwise(_stop(message, "boolean")))
