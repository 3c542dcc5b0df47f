"""Loads that are shown only when they are whole and checked.

Every load fills tables of its own, named ``<table>__<load>``. The name that readers use
is a view of one of them. Publishing a load points the views at its tables, which moves
no data, and a load that fails before that leaves the old rows where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from dailyfacts.operators.tables import create_table, drop_table
from dailyfacts.schemas import TableSpec
from dailyfacts.sources.tables import qualified

#: View property that names the published load.
LOAD = "dailyfacts.load"


def new_load() -> str:
    """A name for a load; later ones sort behind earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"


def of_load(spec: TableSpec, load: str) -> TableSpec:
    """The table that a load fills."""
    return replace(spec, name=f"{spec.name}__{load}", label=spec.title)


def _exists(spark: SparkSession, spec: TableSpec, database: str | None) -> bool:
    return spark.catalog.tableExists(qualified(spec, database))


def published_load(spark: SparkSession, spec: TableSpec, database: str | None = None) -> str | None:
    """The load that the name shows; None for no table or one that was loaded in place."""
    if not _exists(spark, spec, database):
        return None
    properties = spark.sql(f"SHOW TBLPROPERTIES {qualified(spec, database)}").collect()
    return dict(map(tuple, properties)).get(LOAD)


def _show(spark: SparkSession, spec: TableSpec, load: str, database: str | None) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {qualified(spec, database)} TBLPROPERTIES ('{LOAD}' = '{load}')"
        f" AS SELECT * FROM {qualified(of_load(spec, load), database)}"
    )


def publish(spark: SparkSession, specs: Iterable[TableSpec], load: str, database: str | None = None) -> None:
    """Show the tables of a load; when that fails for one, all names show what they showed before.

    A plain table of a name, from a load in place, is dropped, as the view takes its name. Each
    view changes at once, and one after the other: a reader of several should ask
    :func:`published_load` once and read the tables of that load.
    """
    before: list[tuple[TableSpec, str | None]] = []
    try:
        for spec in specs:
            shown = published_load(spark, spec, database)
            if shown is None and _exists(spark, spec, database):
                drop_table(spark, spec, database)
            before.append((spec, shown))
            _show(spark, spec, load, database)
    except Exception:
        for spec, shown in before:
            if shown:
                _show(spark, spec, shown, database)
        raise


def shown_table(spark: SparkSession, spec: TableSpec, database: str | None = None) -> TableSpec:
    """The table that readers of the name get now: one of a load, or the plain one."""
    load = published_load(spark, spec, database)
    return of_load(spec, load) if load else spec


def hide(spark: SparkSession, spec: TableSpec, database: str | None = None) -> None:
    """Drop the view of the name and the tables of all its loads."""
    if published_load(spark, spec, database):
        spark.sql(f"DROP VIEW {qualified(spec, database)}")
    remove_loads(spark, [spec], (), database)


def remove_loads(
    spark: SparkSession, specs: Iterable[TableSpec], keep: Iterable[str | None], database: str | None = None
) -> None:
    """Drop the tables of all loads but the named ones."""
    kept = {load for load in keep if load}
    scope = f" IN `{database}`" if database else ""
    for spec in specs:
        prefix = f"{spec.name}__"
        names = [row["tableName"] for row in spark.sql(f"SHOW TABLES{scope} LIKE '{prefix}*'").collect()]
        loads = {name.removeprefix(prefix).split("__")[0] for name in names if name.startswith(prefix)}
        for load in loads - kept - {"files"}:
            drop_table(spark, of_load(spec, load), database)


def publish_after(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    fill: Callable[..., None],
    database: str | None = None,
) -> str:
    """Create tables for a load, have them filled and checked, and show them; the load's name.

    ``fill`` gets, as ``into``, a function from a table to the one to fill, and raises when a check fails:
    then the new tables go and the names show what they showed. The load shown before is kept
    until the next one, for readers that began with it.
    """
    load = new_load()
    shown = {published_load(spark, spec, database) for spec in specs}
    try:
        for spec in specs:
            create_table(spark, of_load(spec, load), database)
        fill(into=lambda spec: of_load(spec, load))
        publish(spark, specs, load, database)
    except Exception:
        for spec in specs:
            drop_table(spark, of_load(spec, load), database)
        raise
    remove_loads(spark, specs, {load, *shown}, database)
    return load
