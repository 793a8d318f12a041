"""Position of a block on its page, from polygons with page-relative coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where no position can be read, the block counts as mid-page.
MID_PAGE = 0.5


def centroid_y(polygons: Column) -> Column:
    """Mean ``y`` over the points of the first polygon of a VARIANT value.

    Anything else than a non-empty first polygon whose points all carry a numeric ``y``
    gives 0.5; a number in quotes is text, not a number. Coordinates are taken as they
    come, so input must be normalised to 0..1 for position tests to mean anything.
    """

    def numeric_y(point: Column) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(point, "$.y", "variant"))
        return F.when(
            kind.rlike("^(BIGINT|DOUBLE|DECIMAL|BOOLEAN)"), F.try_variant_get(point, "$.y", "double")
        )

    values = F.transform(F.try_variant_get(polygons, "$[0]", "array<variant>"), numeric_y)
    mean = F.aggregate(
        values,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda acc, y: F.struct((acc["sum"] + y).alias("sum"), (acc["n"] + 1).alias("n")),
        lambda acc: F.try_divide(acc["sum"], acc["n"]),
    )
    return F.coalesce(mean, F.lit(MID_PAGE))


def centroid_y_of_json(polygons: Column) -> Column:
    """:func:`centroid_y` for polygons held as JSON text."""
    return centroid_y(F.try_parse_json(polygons))
