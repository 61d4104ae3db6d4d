"""The result document."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.operators.delays import ARR_AVERAGE, DEP_AVERAGE
from punctuality.schema import CAUSES


def _ordered_rows(df: DataFrame, order: list[Column], fields: list[str]) -> Column:
    """All rows of a small report as one array, in the given order.

    ``order`` holds the sort values, ascending. Only for reports of bounded size:
    a top-k list, months, features.
    """
    keyed = F.struct(*[c.alias(f"order{i}") for i, c in enumerate(order)], *fields)
    rows = F.sort_array(F.collect_list(keyed))
    return df.select(
        F.transform(rows, lambda row: F.struct(*[row[f].alias(f) for f in fields]))
    ).scalar()


def _analysis(causes: DataFrame, top_origins: DataFrame, months: DataFrame) -> Column:
    """The analyses as one structure of scalar subqueries."""
    return F.struct(
        causes.select(F.struct(*CAUSES.values())).scalar().alias("delay_causes"),
        _ordered_rows(
            top_origins,
            [-F.col(DEP_AVERAGE), F.col("ORIGIN"), F.col("ORIGIN_CITY_NAME")],
            ["ORIGIN", "ORIGIN_CITY_NAME", "Total_Flights", DEP_AVERAGE],
        ).alias("top_origin_delays"),
        _ordered_rows(
            months,
            [-F.col(ARR_AVERAGE), F.col("Flight_Month")],
            ["Flight_Month", "Total_Flights", ARR_AVERAGE],
        ).alias("monthly_delays"),
    )


def analysis_document(causes: DataFrame, top_origins: DataFrame, months: DataFrame) -> DataFrame:
    """One row ``(analysis)``: the part of the result document that needs no model."""
    return causes.sparkSession.range(1).select(_analysis(causes, top_origins, months).alias("analysis"))


def analysis_rows(document: DataFrame) -> DataFrame:
    """The analyses of a document as ``(part, position, name, flights, value)``, in its order."""
    nothing = F.lit(None).cast("bigint")
    causes = F.array(*[
        F.struct(F.lit(n).alias("name"), nothing.alias("flights"), F.col(f"analysis.delay_causes.{n}").alias("value"))
        for n in CAUSES.values()
    ])
    origins = F.transform("analysis.top_origin_delays", lambda x: F.struct(
        F.concat_ws("|", x["ORIGIN"], x["ORIGIN_CITY_NAME"]).alias("name"), x["Total_Flights"].alias("flights"), x[DEP_AVERAGE].alias("value")
    ))
    months = F.transform("analysis.monthly_delays", lambda x: F.struct(
        x["Flight_Month"].cast("string").alias("name"), x["Total_Flights"].alias("flights"), x[ARR_AVERAGE].alias("value")
    ))
    parts = {"delay_causes": causes, "top_origin_delays": origins, "monthly_delays": months}
    listed = F.array(*[F.struct(F.lit(p).alias("part"), rows.alias("rows")) for p, rows in parts.items()])
    return document.select(F.inline(listed)).select("part", F.posexplode("rows").alias("position", "row")).select(
        "part", "position", "row.name", "row.flights", "row.value"
    )


def result_document(
    causes: DataFrame,
    top_origins: DataFrame,
    months: DataFrame,
    accuracy: DataFrame,
    importance: DataFrame,
) -> DataFrame:
    """One row ``(analysis, machine_learning)`` holding all results of a run.

    Every part is a scalar subquery over a report of bounded size, so nothing is
    joined and nothing is collected to the driver. The accuracy is in percent.
    """
    learning = F.struct(
        accuracy.filter("metric = 'accuracy'").select(100 * F.col("value")).scalar().alias("accuracy"),
        _ordered_rows(importance, [F.col("position")], ["feature", "impact"]).alias(
            "feature_importance"
        ),
    )
    one_row = causes.sparkSession.range(1)
    return one_row.select(_analysis(causes, top_origins, months).alias("analysis"), learning.alias("machine_learning"))


def publish(document: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the document as one JSON file in the folder ``path``."""
    document.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)
