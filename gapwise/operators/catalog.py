"""Node paths, the signal catalogue, stable signal names and filters over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import leaf, matches, parts, slug

MAX_DEPTH = 64


def node_paths(nodes: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """node_id, path: names from the root down, joined by '/'.

    Roots are nodes without a parent or with one that is not in the table.  A blank parent path adds no slash.  Nodes that a
    cycle keeps from any root raise ``ValueError``.
    """
    nodes = nodes.select("node_id", F.coalesce("name", F.lit("")).alias("name"), F.nullif(F.col("parent_node"), F.lit("")).alias("parent"))
    spark = nodes.sparkSession
    return spark.sql(
        """
        WITH RECURSIVE tree(node_id, path, depth) AS (
          SELECT n.node_id, n.name, 1 FROM {nodes} n LEFT ANTI JOIN {nodes} p ON n.parent = p.node_id
          UNION ALL
          SELECT c.node_id, CASE WHEN t.path = '' THEN c.name ELSE concat(t.path, '/', c.name) END, t.depth + 1
          FROM tree t JOIN {nodes} c ON c.parent = t.node_id WHERE t.depth < {depth}
        ) SELECT node_id, path FROM tree""",
        nodes=nodes,
        depth=max_depth,
    )


def check_acyclic(nodes: DataFrame, paths: DataFrame) -> None:
    if nodes.join(paths, "node_id", "left_anti").limit(1).count():
        raise ValueError("some nodes cannot be reached from a root: their parents form a cycle or lie too deep")


def unit_labels(units: DataFrame) -> DataFrame:
    """One label per distinct (code, label): symbol, else name, else code; blanks count as missing."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return units.select(F.col("common_code"), F.coalesce(blank("symbol"), blank("name"), blank("common_code")).alias("unit_symbol")).distinct()


def signal_catalogue(signals: DataFrame, paths: DataFrame, units: DataFrame) -> DataFrame:
    """Signals with their node's path and unit label; both lookups are left joins to small tables."""
    out = signals.join(F.broadcast(paths.withColumnRenamed("node_id", "node_id_uuid")), "node_id_uuid", "left")
    out = out.join(F.broadcast(unit_labels(units)), F.col("unit_code") == F.col("common_code"), "left").drop("common_code")
    out = out.withColumn("unit_symbol", F.coalesce("unit_symbol", "unit_code"))
    return out.select("signal_id", "signal_id_uuid", "node_id_uuid", "unit_code", "unit_symbol", "path")


def catalogue_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("path", "unit_code", "signal_id_uuid", "signal_id")]


def find_signals(catalogue: DataFrame, path: str | None = None, name: str | None = None, unit: str | None = None) -> DataFrame:
    """Rows that match every given regular expression, ignoring case; null never matches."""
    return catalogue.where(matches("path", path) & matches(leaf("path"), name) & matches("unit_code", unit))


def experiments(paths: DataFrame, level: int = 2) -> DataFrame:
    """The distinct path parts at the given depth, sorted."""
    part = F.try_element_at(parts("path"), F.lit(level))
    return paths.select(part.alias("experiment")).where("experiment IS NOT NULL").distinct().orderBy("experiment")


def base_name(path: str | Column = "path", unit: str | Column = "unit_code", source: str | Column = "source") -> Column:
    """A signal's name before collisions are resolved; the first rule that holds wins."""
    path = F.col(path) if isinstance(path, str) else path
    unit = slug(F.coalesce(F.col(unit) if isinstance(unit, str) else unit, F.lit("")))
    source = F.col(source) if isinstance(source, str) else source
    last = F.try_element_at(F.transform(parts(F.coalesce(path, F.lit(""))), slug), F.lit(-1))
    last = F.coalesce(last, unit)
    return (
        F.when(last.startswith("sensor_") | last.startswith("analog_"), last)
        .when((last == "drive") & unit.isin("position", "velocity", "current"), unit)
        .when(unit.isin("pressure", "temperature", "counter"), unit)
        .when((unit == "vibration") & (source == "uuid"), F.concat(F.lit("vibration_"), last))
        .otherwise(F.concat_ws("_", unit, last))
    )


def unique_names(rows: list[tuple[str, str]]) -> list[str]:
    """Names for (base, path) rows in order: a taken base tries its path's parts from leaf to root, then numbers."""
    used: set[str] = set()
    out = []
    for base, path in rows:
        tried = [base, *(f"{base}_{p.strip().lower().replace(' ', '_')}" for p in reversed([x for x in (path or "").split("/") if x]))]
        name = next((t for t in tried if t not in used), None)
        k = 2
        while name is None:
            name = f"{base}_{k}" if f"{base}_{k}" not in used else None
            k += 1
        used.add(name)
        out.append(name)
    return out


def experiment_signals(uuid_catalogue: DataFrame, int_catalogue: DataFrame, experiment: str, exact: bool = False) -> DataFrame:
    """The experiment's signals under stable names.  A catalogue holds few signals; names are settled on the driver."""
    both = uuid_catalogue.withColumn("source", F.lit("uuid")).unionByName(int_catalogue.withColumn("source", F.lit("int")))
    want = F.array_contains(parts("path"), experiment) if exact else matches("path", experiment)
    both = both.where(want).withColumn("__base", base_name()).orderBy(F.col("source").desc(), *catalogue_order())
    rows = both.collect()
    names = unique_names([(r["__base"], r["path"]) for r in rows])
    fields = ("source", "signal_id", "signal_id_uuid", "unit_code", "unit_symbol", "path")
    from ..schemas import EXPERIMENT_SIGNALS

    return both.sparkSession.createDataFrame([(n, *(r[f] for f in fields)) for n, r in zip(names, rows, strict=True)], EXPERIMENT_SIGNALS)


def exactly_one(df: DataFrame, what: str):
    """The only row, or ``ValueError``."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one {what}, found {'none' if not rows else 'several'}")
    return rows[0]


def optional_one(df: DataFrame):
    """The only row, or None if there are none or several."""
    rows = df.limit(2).collect()
    return rows[0] if len(rows) == 1 else None
