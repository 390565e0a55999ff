"""Image annotations and detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

def read_coco(spark, path):
    """Images, annotations and categories of JSON documents with these three arrays."""
    doc = spark.read.option("multiLine", True).json(path)
    part = lambda name: doc.select(F.explode(name).alias("x")).select("x.*")
    return part("images"), part("annotations"), part("categories")


def nest_annotations(images, annotations, key="image_id", fields=("bbox", "category", "area", "id")) -> DataFrame:
    """Images with their annotations as parallel arrays in id order; none give empty arrays.

    One row per image whatever its size: a record is what a training step reads
    as a whole.  For images beyond a row, keep the annotations long (image, id
    and fields), as :func:`read_coco` gives them.
    """
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(f) for f in ("id", *[f for f in fields if f != "id"])])))
    nested = annotations.groupBy(key).agg(rows.alias("_rows"))
    objects = F.struct(*[F.col("_rows")[f].alias(f) for f in fields]).alias("objects")
    packed = nested.select(F.col(key).alias("_k"), objects)
    empty = F.struct(
        *[F.array().cast(f"array<{annotations.schema[f].dataType.simpleString()}>").alias(f) for f in fields]
    )
    return images.join(packed, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("objects", F.coalesce("objects", empty))


def to_records(images, annotations) -> DataFrame:
    """Nested image records with the bare file name."""
    named = images.select(text.basename(F.col("file_name")).alias("file_name"), F.col("id").alias("image_id"))
    boxes = annotations.withColumnRenamed("category_id", "category")
    return nest_annotations(named, boxes)


def label_map(classes) -> Column:
    """Map literal of a class list, ``{id: name}``; a class table is joined instead (:func:`named`)."""
    return F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])


def named(df, categories, key="id", name="name") -> DataFrame:
    """``df`` with the name of its class id; unknown ids get null."""
    lookup = categories.select(F.col(key).alias("_id"), F.col(name).alias("_name"))
    return df.join(lookup, F.col(key) == F.col("_id"), "left").drop("_id").withColumnRenamed("_name", name)


def box_structs(objects="objects"):
    """Boxes and categories zipped to annotation structs."""
    o = F.col(objects)
    return F.transform(
        F.arrays_zip(o["bbox"].alias("bbox"), o["category"].alias("category")),
        lambda x: F.struct(
            x["bbox"].alias("bbox"),
            x["category"].cast("int").alias("category_id"),
            F.lit(0).alias("iscrowd"),
            F.lit(0).alias("area"),
        ),
    )


# Classes counted by default.
CLASSES = ["Moon", "Insect", "Black_star", "Grey_star", "Unicorn_whole", "Unicorn_head", "Owl", "Cat"]


def class_counts(detections, classes=CLASSES, threshold=0.15) -> DataFrame:
    """Detections at or above the threshold per listed class, 0 where there are none."""
    names = detections.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    counts = detections.filter(F.col("score") >= threshold).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
