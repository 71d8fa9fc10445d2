"""The numbers behind the dashboard tiles.

The reference pulls up to 500,000 joined rows into one pandas process and
aggregates there.  Here every tile is an aggregate over the whole fact on the
cluster; only its result (at most a few hundred rows) leaves it.

Tile semantics follow pandas: ``value_counts`` / ``groupby`` drop NULL keys,
``mean`` of the met flag counts NULL as not met, top-N lists break count ties
by key, month labels are ``yyyy-MM`` and NULL months are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean_at_rest, met_as_false, month_label
from ..operators.star import Dimensions, fact_with_keys, warehouse_fact
from .reports import at_rest


def dashboard_base(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Stored fact LEFT JOIN projects and agents, all rows.  The
    keyed fact still carries the names the key joins would fetch back."""
    keyed = fact_with_keys(fact, dims)
    return warehouse_fact(keyed.withColumns({"_project_name": F.col("project"),
                                             "_agent_name": F.col("assignee")}),
                          extra=("_project_name", "_agent_name")).withColumnsRenamed(
        {"_project_name": "project_name", "_agent_name": "agent_name"})


def dashboard_base_stored(fact_tickets: DataFrame, dim_projects: DataFrame,
                          dim_agents: DataFrame) -> DataFrame:
    """S7 on the stored tables: fact LEFT JOIN projects LEFT JOIN agents on
    their keys, every row (no row cap).  Dimension tables are joined as-is;
    AQE broadcasts them from their measured size."""
    return (fact_tickets
            .join(dim_projects, "project_id", "left")
            .join(dim_agents, "agent_id", "left")
            .select(*fact_tickets.columns, "project_name", "agent_name"))


def display_frame(fact: DataFrame) -> DataFrame:
    """What the tiles read: hours at rest, the start month as text, and the
    project and agent names if the fact carries them."""
    names = {"project": "project_name", "assignee": "agent_name"}
    return (at_rest(fact).withColumn("ym", month_label("start_time"))
            .withColumnsRenamed({c: n for c, n in names.items() if c in fact.columns}))


def preview(frame: DataFrame, n: int = 5) -> DataFrame:
    """The first rows by ticket id."""
    return frame.orderBy("ticket_id").limit(n)


def _met_pct() -> F.Column:
    return F.avg(met_as_false("resolution_target_met").cast("int")) * F.lit(100.0)


def kpi_overall_compliance(d: DataFrame) -> DataFrame:
    """A3: met tickets over all tickets, NULL verdicts as not met."""
    return d.agg(_met_pct().alias("overall_compliance_pct"))


def top_category(d: DataFrame) -> DataFrame:
    """Mode of the category (NULLs ignored, smallest on ties), as a
    distributed count and top-1 rather than one buffer of all categories."""
    return top_n_by_count(d, "category", 1).select(F.col("category").alias("top_category"))


def kpi_total_tickets(d: DataFrame) -> DataFrame:
    """A5."""
    return d.agg(F.count(F.lit(1)).alias("total_tickets"))


def top_n_by_count(d: DataFrame, col: str, n: int) -> DataFrame:
    """O3: the n most frequent non-NULL values of ``col``."""
    return (d.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("tickets"))
            .orderBy(F.col("tickets").desc(), F.col(col))
            .limit(n))


# The count tiles of the dashboard: column -> how many values it shows.
COUNT_TILES = {"status": 15, "priority": 10, "category": 10, "project_name": 15}


def top_n_by_count_tiles(d: DataFrame, tiles: dict[str, int] = COUNT_TILES) -> DataFrame:
    """O3 for all count tiles in one pass: each ticket row is exploded into
    (dimension, value) pairs, counted, and the first n values of every
    dimension kept (the window runs over grouped values, not tickets)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"),
                                         F.col(c).cast("string").alias("value"))
                                for c in tiles]))
    limit = F.create_map(*[x for c, n in tiles.items() for x in (F.lit(c), F.lit(n))])
    counts = (d.select(pairs.alias("p")).select("p.dimension", "p.value")
              .filter(F.col("value").isNotNull())
              .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("tickets")))
    order = Window.partitionBy("dimension").orderBy(F.col("tickets").desc(), F.col("value"))
    return (counts.withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= limit[F.col("dimension")])
            .drop("_rank"))


def tickets_by_status(d: DataFrame) -> DataFrame:
    return top_n_by_count(d, "status", 15)        # A6


def tickets_by_priority(d: DataFrame) -> DataFrame:
    return top_n_by_count(d, "priority", 10)      # A7


def tickets_by_category(d: DataFrame) -> DataFrame:
    return top_n_by_count(d, "category", 10)      # A8


def top_projects(d: DataFrame) -> DataFrame:
    return top_n_by_count(d, "project_name", 15)  # A12


def top_agents_by_tickets(d: DataFrame) -> DataFrame:
    """Agents by number of tickets (all tickets, resolved or not)."""
    return top_n_by_count(d, "agent_name", 10)


def _last_n_months(monthly: DataFrame, n: int) -> DataFrame:
    """The n latest ``ym`` rows of a per-month frame, earliest first."""
    return monthly.orderBy(F.col("ym").desc()).limit(n).orderBy("ym")


def tickets_per_month(d: DataFrame, n: int = 20) -> DataFrame:
    """Tickets per start month, latest n months."""
    monthly = (d.filter(F.col("ym").isNotNull()).groupBy("ym")
               .agg(F.count(F.lit(1)).alias("tickets")))
    return _last_n_months(monthly, n)


def avg_hours_by_priority(d: DataFrame, n: int = 10) -> DataFrame:
    """A10: unrounded mean hours per priority, n largest."""
    return (d.filter(F.col("priority").isNotNull()).groupBy("priority")
            .agg(mean_at_rest("resolution_duration_hours").alias("avg_hours"))
            .filter(F.col("avg_hours").isNotNull())
            .orderBy(F.col("avg_hours").desc(), "priority")
            .limit(n))


def target_met_split(d: DataFrame) -> DataFrame:
    """Met / missed share among tickets with a verdict."""
    counts = (d.filter(F.col("resolution_target_met").isNotNull())
              .groupBy("resolution_target_met").agg(F.count(F.lit(1)).alias("tickets")))
    total = F.sum("tickets").over(Window.partitionBy())  # over <= 2 grouped rows
    return counts.withColumn("share_pct", F.lit(100.0) * F.col("tickets") / total)


def compliance_by_priority_all(d: DataFrame) -> DataFrame:
    """Met share over all tickets of each priority."""
    return (d.filter(F.col("priority").isNotNull()).groupBy("priority")
            .agg(_met_pct().alias("compliance_pct")).orderBy("compliance_pct", "priority"))


def monthly_compliance_trend(d: DataFrame, n: int = 20) -> DataFrame:
    """Met share over all tickets per start month, latest n months."""
    monthly = (d.filter(F.col("ym").isNotNull()).groupBy("ym")
               .agg(_met_pct().alias("compliance_pct")))
    return _last_n_months(monthly, n)


def top_agents_avg_hours(d: DataFrame, n: int = 10) -> DataFrame:
    """Mean hours of the n agents with most tickets (one grouping)."""
    return (d.filter(F.col("agent_name").isNotNull()).groupBy("agent_name")
            .agg(F.count(F.lit(1)).alias("tickets"),
                 mean_at_rest("resolution_duration_hours").alias("avg_hours"))
            .orderBy(F.col("tickets").desc(), "agent_name")
            .limit(n))


def _heat_rows(d: DataFrame, n_categories: int, n_months: int) -> DataFrame:
    """Counts per (category, month) for the top categories of all time and
    the latest months of all months: two distributed top-N lists, and the
    tickets semi-joined to them."""
    categories = top_n_by_count(d, "category", n_categories).select("category")
    months = (d.filter(F.col("ym").isNotNull()).select("ym").distinct()
              .orderBy(F.col("ym").desc()).limit(n_months))
    return (d.select("category", "ym").join(categories, "category", "left_semi")
            .join(months, "ym", "left_semi")
            .groupBy("category", "ym").agg(F.count(F.lit(1)).alias("ticket_count")))


def category_month_heatmap_wide(d: DataFrame, n_categories: int = 10,
                                n_months: int = 12) -> DataFrame:
    """Category x month counts, one column per month, 0 filled.  The
    (at most n_months) labels are read first, so the pivot is one pass."""
    counts = _heat_rows(d, n_categories, n_months)
    months = [r.ym for r in d.filter(F.col("ym").isNotNull()).select("ym").distinct()
              .orderBy(F.col("ym").desc()).limit(n_months).collect()]
    return (counts.groupBy("category").pivot("ym", sorted(months)).agg(F.first("ticket_count"))
            .na.fill(0).orderBy("category"))


def category_month_heatmap(d: DataFrame, n_categories: int = 10, n_months: int = 12) -> DataFrame:
    """A17 in long form: (category, ym, ticket_count) over every category x
    month pair of the heat map, zeros included.

    The grid is built from the aggregated counts (at most n_categories x
    n_months rows, so the all-rows window below is bounded by construction):
    each category row carries the list of months present and its own counts
    as a map, and the list is exploded."""
    counts = _heat_rows(d, n_categories, n_months)
    months = F.array_sort(F.collect_set("ym").over(Window.partitionBy()))
    per_category = (counts.withColumn("_months", months)
                    .groupBy("category")
                    .agg(F.first("_months").alias("_months"),
                         F.map_from_entries(F.collect_list(F.struct("ym", "ticket_count")))
                         .alias("_counts")))
    return (per_category.select("category", "_counts", F.explode("_months").alias("ym"))
            .select("category", "ym",
                    F.coalesce(F.col("_counts")[F.col("ym")], F.lit(0).cast("long"))
                    .alias("ticket_count")))
