"""Loading only the years that are missing, then rebuilding what depends on them.

A run ends by noting its version and the fingerprints of what it was made from:
each year of counts and each reference table. Until then nothing counts as
loaded: a run that breaks off is done again by the next one, and readers keep
the gold of the last run that ended. What is rebuilt follows from the notes
alone, not from tables that a broken-off run may have left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid import session
from viagrid.functions.cleaning import whole
from viagrid.operators.fingerprint import fingerprints
from viagrid.operators.lookup import missing_from
from viagrid.operators.quarantine import Gate, checked, put_aside
from viagrid.plans import annual, dates, silver
from viagrid.session import folder_exists, remove_folder, work_folder
from viagrid.sources import sinks

NOTHING_YET = 1999
NOTES = "version int, input string, year int, fingerprint string"
#: Reference tables whose names stand in the yearly tables.
NAMED = ("regions", "local_authorities")
#: Notes of an attempt on what it is about to replace of the silver counts.
SILVER_YEARS, SILVER_WHOLE = "silver of its years", "silver of all years"
#: Before the name of a reference table: the note on its raw rows, of which bronze and silver were made without a gate.
RAW = "raw "


#: Reference tables and what makes silver of them.
REFERENCE = {"count_points": silver.annual_count_points, "regions": silver.named_areas, "local_authorities": silver.named_areas}


def high_water_mark(gold: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The last year loaded, one row; 1999 where there is none."""
    if gold is None:
        return spark.range(1).select(F.lit(NOTHING_YET).alias("latest_year"))
    return gold.agg(F.coalesce(F.max("year"), F.lit(NOTHING_YET)).alias("latest_year"))


def _notes(spark: SparkSession, path: str) -> DataFrame | None:
    if not folder_exists(spark, path):
        return None
    return spark.read.schema(NOTES).parquet(path).withColumn("input", F.coalesce("input", F.lit("counts")))


def progress(spark: SparkSession, base: str) -> DataFrame | None:
    """What every finished run has loaded: its version, and per year of counts and per reference table a fingerprint, of the latter also one of its raw rows."""
    return _notes(spark, f"{base}/progress")


def _version(done: DataFrame | None) -> int:
    return 0 if done is None else done.agg(F.max("version")).first()[0]


def gold_path(spark: SparkSession, base: str, table: str) -> str:
    """Where the last finished run has put a gold table."""
    return f"{base}/gold/v{_version(progress(spark, base)):06d}/{table}"


def gold_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(gold_path(spark, base, table))


def missing_years(source: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Years the source has and ``loaded`` lacks, gaps in the middle included."""
    offered = source.select(whole(F.col("year")).alias("year")).filter(F.col("year").isNotNull())
    return offered.distinct() if loaded is None else missing_from(offered, loaded, "year")


def offered_years(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """The years of a source; of a folder with a partition per year they are read off the folders' names, and no file is opened."""
    if isinstance(source, str):
        folders = [name.partition("=") for name in session.names_in(spark, source)]
        years = [(value,) for column, _, value in folders if column == "year"]
        if years:
            return spark.createDataFrame(years, "year string")
    return as_table(spark, source)


def as_table(spark: SparkSession, source: DataFrame | str, years: Sequence[int] | None = None) -> DataFrame:
    """A source as a table; of a folder with a partition per year only the partitions of ``years``, where those are given."""
    if not isinstance(source, str):
        return source
    if years is not None:
        wanted = set(years)
        folders = [name for name in session.names_in(spark, source) if name.startswith("year=")]
        kept = [f"{source}/{name}" for name in folders if name[5:].isdigit() and int(name[5:]) in wanted]
        if kept:
            return spark.read.option("basePath", source).parquet(*kept)
    return spark.read.parquet(source)


def load_missing(source: DataFrame, loaded: DataFrame | None, bronze_path: str) -> list[int]:
    """Write the missing years to the raw table; returns them.

    Each year is one partition and is replaced as a whole, so a load that is
    repeated, for instance after a failure, leaves no year twice. The files keep
    the year as a column; the partition is a copy of it. Rows without a year
    stay out, as the silver rules would drop them.
    """
    years = sorted(row["year"] for row in missing_years(source, loaded).collect())
    load_years(source, years, bronze_path)
    return years


def load_years(source: DataFrame, years: Sequence[int], bronze_path: str) -> None:
    """Write some years to the raw table, each replaced as a whole."""
    if years:
        dated = source.withColumn("load_year", whole(F.col("year")))
        fresh = dated.filter(F.col("load_year").isin(*years))
        sinks.write_table(fresh, bronze_path, ["load_year"], replace_only_present=True)


def read_loaded(spark: SparkSession, bronze_path: str, years: Sequence[int] | None = None) -> DataFrame:
    """The raw table, or its partitions of some years."""
    df = spark.read.parquet(bronze_path)
    if years is not None:
        df = df.filter(F.col("load_year").isin(*years))
    return df.drop("load_year")


def refresh_reference(tables: dict[str, DataFrame], base: str) -> None:
    """Replace the reference tables whole, beside an incremental load."""
    for name, df in tables.items():
        sinks.write_table(df, f"{base}/{name}")


def rebuild_silver(
    spark: SparkSession, bronze: str, silver_base: str, years: Sequence[int] | None = None, gate: Gate | None = None,
    aside: str | None = None, reference: dict[str, DataFrame] | None = None,
) -> None:
    """Silver counts of some years (None: all), and the other silver tables whole.

    ``reference`` are the latter as silver takes them, where they are stored
    already (those it lacks stay as they are); else they are made of the raw tables. With a gate all of it is held against that before silver is touched; rows
    that break a rule go to ``aside`` instead, those of counts by year.
    """
    tables = {"counts": silver.annual_counts(read_loaded(spark, f"{bronze}/counts", years))}
    if reference is None:
        reference = {name: conform(spark.read.parquet(f"{bronze}/{name}")) for name, conform in REFERENCE.items()}
    tables |= reference
    kept = work_folder(spark, "silver")
    try:
        if gate is not None:
            passed = {name: checked(spark, df, name, gate, f"{kept}/{name}") for name, df in tables.items()}
            for name in reference:
                put_aside(spark, passed[name], f"{aside}/{name}")
            for year in [None] if years is None else years:
                remove_folder(spark, f"{aside}/counts" + ("" if year is None else f"/year={year}"))
            sinks.write_table(passed["counts"].rejected, f"{aside}/counts", ["year"], replace_only_present=True)
            tables = {name: found.good for name, found in passed.items()}
        for year in years or ():  # also those that have no row left
            remove_folder(spark, f"{silver_base}/counts/year={year}")
        sinks.write_table(
            sinks.with_processed_time(tables["counts"]), f"{silver_base}/counts", ["year"], replace_only_present=years is not None
        )
        for name in reference:
            sinks.write_table(sinks.with_processed_time(tables[name]), f"{silver_base}/{name}")
    finally:
        remove_folder(spark, kept)


def gold_tables(
    counts: DataFrame, regions: DataFrame, authorities: DataFrame, base_year: int = 2019,
    last_year: int | None = None, busiest_year: int | None = None, first_day_year: int | None = 2000,
    stored: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The eight gold tables on annual flows, by name.

    ``stored`` are tables of ``yearly_tables`` and ``roads`` where they are
    written already; what is lacking is computed from the counts.
    """
    made = {**yearly_tables(counts, regions, authorities), **(stored or {})}
    roads = made["roads"] if "roads" in made else annual.road_totals(counts, regions, busiest_year)
    return {
        "fact_traffic_summary": annual.summary_from(made["totals"]),
        "fact_co2_emissions": annual.co2_from(made["totals"]),
        "fact_vehicle_mix": annual.mix_from(made["totals"]),
        "fact_road_analysis": made["road_analysis"],
        "fact_covid_impact": annual.impact_from(made["totals"], base_year, last_year),
        "fact_busiest_roads": annual.busiest_from(roads),
        "dim_location": annual.location_from(made["locations"]),
        "dim_date": dates.date_dim(dates.spine_of(counts, first_day_year)),
    }


def yearly_tables(counts: DataFrame, regions: DataFrame, authorities: DataFrame) -> dict[str, DataFrame]:
    """What gold needs of each year, independent of every other year."""
    return {
        "totals": annual.regional_totals(counts, regions),
        "road_analysis": annual.road_analysis(counts, regions),
        "locations": annual.yearly_locations(counts, regions, authorities),
        "points": annual.point_bitmaps(counts, regions),
    }


def rebuild_gold(
    spark: SparkSession, base: str, gold_base: str, years: Sequence[int] | None = None, **options
) -> dict[str, str]:
    """All gold tables, unpartitioned so that the files keep ``year``.

    Counts are read for ``years`` alone (None: all): their yearly tables replace
    those years below ``base/yearly``, and gold follows from these.
    """
    counts, regions, authorities = (
        spark.read.parquet(f"{base}/silver/{name}") for name in ("counts", "regions", "local_authorities")
    )
    fresh = counts if years is None else counts.filter(F.col("year").isin(*years))
    made = yearly_tables(fresh, regions, authorities)
    sinks.write_table(made.pop("points"), f"{base}/yearly/points", ["year"], replace_only_present=years is not None)
    points = spark.read.schema(annual.POINTS).parquet(f"{base}/yearly/points")
    made["totals"] = annual.totals_with_points(fresh, regions, points if years is None else points.filter(F.col("year").isin(*years)))
    for name, df in made.items():
        sinks.write_table(df, f"{base}/yearly/{name}", ["year"], replace_only_present=years is not None)
    stored = {name: spark.read.parquet(f"{base}/yearly/{name}") for name in ("totals", "road_analysis", "locations")}
    kept = work_folder(spark, "road-totals")
    try:
        sinks.write_table(annual.road_totals(counts, regions, options.get("busiest_year")), kept)
        stored["roads"] = spark.read.parquet(kept)
        tables = gold_tables(counts, regions, authorities, **options, stored=stored)
        paths = {name: f"{gold_base}/{name}" for name in tables}
        for name, df in tables.items():
            sinks.write_table(df, paths[name])
    finally:
        remove_folder(spark, kept)
    return paths


def year_prints(rows: DataFrame) -> dict[int, str]:
    """The fingerprint of each year of counts."""
    dated = rows.withColumn("_year", whole(F.col("year"))).filter(F.col("_year").isNotNull())
    return {r["_year"]: r["fingerprint"] for r in fingerprints(dated, ["_year"]).collect()}


def loaded_prints(spark: SparkSession, bronze_path: str, years: Sequence[int]) -> dict[int, str]:
    """``year_prints`` of years of the raw table, which are read off its folders and not cast once more."""
    rows = spark.read.parquet(bronze_path).filter(F.col("load_year").isin(*years)).withColumnRenamed("load_year", "_year")
    return {r["_year"]: r["fingerprint"] for r in fingerprints(rows, ["_year"]).collect()}


def conformed(spark: SparkSession, reference: dict[str, DataFrame], kept: str) -> dict[str, DataFrame]:
    """These reference tables as silver takes them, computed once into ``kept``."""
    for name, df in reference.items():
        sinks.write_table(REFERENCE[name](df), f"{kept}/{name}")
    return {name: spark.read.parquet(f"{kept}/{name}") for name in reference}


def raw_print(df: DataFrame) -> str:
    """The fingerprint of a reference table as it comes, and its columns."""
    return f"{fingerprints(df).first()['fingerprint']} {df.schema.simpleString()}"


def _unchanged(spark: SparkSession, base: str, raw: dict[str, str], noted: dict[tuple[str, int | None], str | None]) -> set[str]:
    """Reference tables whose raw rows are those that the last finished run has made bronze and silver of."""
    return {
        name for name, found in raw.items()
        if noted.get((f"{RAW}{name}", None)) == found and noted.get((name, None)) is not None
        and all(folder_exists(spark, f"{base}/{layer}/{name}") for layer in ("bronze", "silver"))
    }


def reference_prints(tidy: dict[str, DataFrame]) -> dict[str, str]:
    """The fingerprint of each reference table, of the columns that silver takes from it."""
    return {name: fingerprints(df).first()["fingerprint"] for name, df in tidy.items()}


def _last_notes(notes: DataFrame | None, after: int = -1) -> dict[tuple[str, int | None], str | None]:
    """The newest print of each year and reference table, of versions over ``after``."""
    if notes is None:
        return {}
    rows = notes.filter(F.col("version") > after).groupBy("input", "year").agg(F.max_by("fingerprint", "version").alias("fingerprint"))
    return {(r["input"], r["year"]): r["fingerprint"] for r in rows.collect()}


def _note(spark: SparkSession, path: str, version: int, prints: dict[tuple[str, int | None], str | None]) -> None:
    rows = [(version, name, year, found) for (name, year), found in prints.items()]
    sinks.append_rows(spark.createDataFrame(rows, NOTES).coalesce(1), path)


def run(
    spark: SparkSession, source: DataFrame | str, reference: dict[str, DataFrame], base: str, recheck: bool = False,
    gate: Gate | None = None, **options
) -> str:
    """One incremental run below ``base``: load, rebuild what it changes, then note it as done.

    ``source`` is a table, or a Parquet folder: if that has a partition per
    year, what it offers is read off the folders, and only the years that are
    loaded are read at all. Loaded are the years that no finished run has loaded; with ``recheck``,
    which reads the whole source, also years whose rows have changed since. All
    years are rebuilt if a region or an authority has another name than in the
    last finished run, or if a run between the two that broke off had yet
    others; else the years loaded now, and those of runs that broke off. Silver
    counts hold no names, so a rename leaves those of other years as they are
    unless a gate is to see them. A reference table whose raw rows are those of
    the last finished run is read for their fingerprint alone, and stays as it is
    in bronze and silver; not so under a gate, or after a run that broke off. Years
    that the source offers no longer stay. Nothing is done where nothing has
    changed. The gold of the run before stays for readers that are still at it;
    older ones are removed.

    With a gate, what is rebuilt is held against it first. Rows that break a
    rule go to ``quarantine`` instead of silver; where too many do, the run
    stops before silver and gold are touched, and the years count as not loaded.
    """
    session.short_methods(spark)
    kept = work_folder(spark, "reference")
    try:
        return _run(spark, source, reference, kept, base, recheck, gate, options)
    finally:
        remove_folder(spark, kept)


def _run(
    spark: SparkSession, source: DataFrame | str, reference: dict[str, DataFrame], kept: str, base: str, recheck: bool,
    gate: Gate | None, options: dict,
) -> str:
    """``run``, with a folder for the reference tables as silver takes them."""
    done = progress(spark, base)
    version = _version(done) + 1
    noted = _last_notes(done)
    broken = _last_notes(_notes(spark, f"{base}/attempts"), after=version - 1)
    raw = {name: None if gate else raw_print(reference[name]) for name in REFERENCE}
    same = set() if gate or broken else _unchanged(spark, base, raw, noted)
    reference = {name: df for name, df in reference.items() if name not in same}
    tidy = conformed(spark, {name: reference[name] for name in REFERENCE if name not in same}, kept)
    years = {row["year"] for row in missing_years(offered_years(spark, source), done).collect()} | {year for name, year in broken if name == "counts"}
    changed: set[int] = set()
    if recheck and done is not None:
        offered = year_prints(as_table(spark, source))
        changed = {year for year, found in offered.items() if found != noted.get(("counts", year)) and ("counts", year) in noted}
    prints = {(name, None): noted[name, None] for name in same} | {(name, None): found for name, found in reference_prints(tidy).items()}
    if not years and not changed and not broken and all(noted.get(key) == found for key, found in prints.items()):
        return "NO_NEW_DATA"
    _note(spark, f"{base}/attempts", version, {**prints, **{("counts", year): None for year in years | changed}})
    bronze = f"{base}/bronze"
    load_years(as_table(spark, source, sorted(years | changed)), sorted(years | changed), f"{bronze}/counts")
    refresh_reference(reference, bronze)
    renamed = any(seen.get((name, None), prints[name, None]) != prints[name, None] for seen in (noted, broken) for name in NAMED)
    loading = sorted(years | changed)
    whole_silver = done is None or _torn(broken) or bool(changed) and (
        gate is not None or not changed <= _usable_years(spark, bronze, sorted(changed))  # a year without rows left is replaced only with all others
    )
    stale = None if whole_silver or renamed else loading
    fresh = None if whole_silver or renamed and gate is not None else loading  # silver counts have ids, no names
    _note(spark, f"{base}/attempts", version, {(SILVER_YEARS if fresh is not None else SILVER_WHOLE, None): None})
    rebuild_silver(spark, bronze, f"{base}/silver", fresh, gate, f"{base}/quarantine", tidy)
    rebuild_gold(spark, base, f"{base}/gold/v{version:06d}", stale, **options)
    loaded = loaded_prints(spark, f"{bronze}/counts", loading)
    made_of = {(f"{RAW}{name}", None): found for name, found in raw.items()}
    _note(spark, f"{base}/progress", version, {**prints, **made_of, **{("counts", year): found for year, found in loaded.items()}})
    remove_folder(spark, f"{base}/gold/v{version - 2:06d}")
    return "LOADED"


def _torn(broken: dict[tuple[str, int | None], str | None]) -> bool:
    """Whether a run that broke off may have left silver without years that were loaded before it: not if it replaced single years."""
    return bool(broken) and ((SILVER_WHOLE, None) in broken or (SILVER_YEARS, None) not in broken)


def _usable_years(spark: SparkSession, bronze: str, years: Sequence[int]) -> set[int]:
    """Years of the raw table that have rows for silver."""
    if not years:
        return set()
    counts = silver.annual_counts(read_loaded(spark, f"{bronze}/counts", years))
    return {row["year"] for row in counts.select("year").distinct().collect()}
