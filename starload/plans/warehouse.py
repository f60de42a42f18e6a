"""The whole load: landing files to staging, dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.columns import differs, money_sum
from starload.functions.spines import Window, legacy_delete_window, period_of, trailing_window
from starload.operators.changes import INSERT, OP, UPDATE
from starload.operators.dedupe import keep_first
from starload.operators.normalize import CHILDREN, normalize
from starload.operators.numbering import assign_surrogates
from starload.operators.reload import doomed_keys, overwrite_partitions
from starload.plans.dimensions import DIMENSIONS, load_dimension, members
from starload.plans.facts import (
    BRIDGES, FUNDING, FUNDING_FACT, FUNDING_TABLE, MAIN_FACT, PROJECT, bridge_fact, funding_fact, load_fact, project_fact, unique_funding,
)
from starload.plans.ledger import Ledger
from starload.plans.measures import Measures, landing_checks, row_checks
from starload.plans.snapshots import (
    PERIOD, add_missing, changed_rows, drop_old_versions, merge_periods, newest, periods_of, read_periods, read_snapshot, remove_copies,
    replace_by_key, replace_where, replace_window, with_period, write_snapshot,
)
from starload.schemas import EXECUTION_LANDING, EXECUTION_TABLE, LINEAGE, PARENT_TABLE
from starload.session import adaptive
from starload.sources.files import file_lineage, read_chosen_json
from starload.sources.folders import matching, remove

Tables = dict[str, DataFrame]
FACTS = [MAIN_FACT, FUNDING_FACT, *[bridge.table for bridge in BRIDGES]]

# The columns that identify a row of each staging table.
STAGING_KEYS = {
    f"{PARENT_TABLE}_eixos": ["idunico", "id"],
    f"{PARENT_TABLE}_executores": ["idunico", "codigo"],
    f"{PARENT_TABLE}_fontes_de_recurso": ["idunico", "origem", "valorinvestimentoprevisto"],
    f"{PARENT_TABLE}_repassadores": ["idunico", "codigo"],
    f"{PARENT_TABLE}_sub_tipos": ["idunico", "id"],
    f"{PARENT_TABLE}_tipos": ["idunico", "id"],
    f"{PARENT_TABLE}_tomadores": ["idunico", "codigo"],
    PARENT_TABLE: ["idunico"],
}
CHILD_TABLES = [child.table for child in CHILDREN]
STAGING = [*CHILD_TABLES, PARENT_TABLE, EXECUTION_TABLE]
# The column whose period names the partition of a row.
DAY_COLUMNS = ("datacadastro", "data_projeto")


def each(spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]], at_once: int = 3) -> Tables:
    """Run independent writes, a few at a time so that small ones fill the cluster together.

    Those that run together hold their shuffle files on disk and their plans in the driver at the same time.
    """
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in started.items()}


def dedupe_staging(staging: Tables) -> Tables:
    """Keep one row per key; execution rows are made distinct, tables without a key pass."""
    cleaned = {}
    for name, df in staging.items():
        if name in STAGING_KEYS:
            df = keep_first(df, STAGING_KEYS[name])
        elif name == EXECUTION_TABLE:
            df = df.distinct()
        cleaned[name] = df
    return cleaned


def land_columnar(nested: DataFrame, root: str, measures: Measures | None = None) -> DataFrame:
    """Write parsed landing records once as Parquet, nested arrays included.

    Text is parsed a single time; the nine staging branches then each read only the
    columns they need. ``measures`` counts on the way what the records lack.
    """
    if measures is not None:
        nested = measures.watch(nested, landing_checks(nested))
    return write_snapshot(nested, f"{root}/landed")


def load_staging(
    nested: DataFrame, root: str, strict_dates: bool = False, only: set[str] | None = None, measures: Measures | None = None
) -> Tables:
    """Staging tables of landing records (with their lineage column), read from one columnar copy.

    Arrays of which ``only`` names no table are not written to it.
    """
    if measures is not None:
        # counted on whole records, also what is not written
        nested = measures.watch(nested, landing_checks(nested))
    unused = [child.array for child in CHILDREN if only is not None and child.table not in only]
    return normalize(land_columnar(nested.drop(*unused), root), strict_dates, only)


class Warehouse:
    """Names and places of the tables of one load target.

    Staging is partitioned by the period of its registration date (``grain``), execution
    rows by their source file, the project dimension and the facts by the period of their project, so that a reload rewrites
    only what it replaces. ``measures`` counts violations and changes as tables are written. With ``enforce`` rows of a
    dimension or fact that lack a required value or are too long fail the load before the table has them.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = "month", enforce: bool = False):
        self.spark, self.root, self.grain, self.enforce = adaptive(spark), root.rstrip("/"), grain, enforce
        self.measures = Measures(spark)

    def place(self, table: str) -> str:
        return f"{self.root}/{table}"

    def current(self, table: str) -> DataFrame | None:
        return read_snapshot(self.spark, self.place(table))

    def is_empty(self) -> bool:
        """Whether no table has been written yet."""
        return all(newest(self.spark, self.place(table)) is None for table in [*STAGING, *[d.table for d in DIMENSIONS], *FACTS])

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Write the next version of a table, all of it."""
        if table not in STAGING:  # whose rows are counted as they land
            df = self.measures.watch(df, row_checks(table, df.columns))
        if table == EXECUTION_TABLE:
            return write_snapshot(df, self.place(table), LINEAGE)
        day = next((name for name in DAY_COLUMNS if name in df.columns), None)
        if day is not None:
            df = with_period(df, day, self.grain)
        written = write_snapshot(df, self.place(table), PERIOD if PERIOD in df.columns else None)
        if self.enforce and table not in STAGING:
            try:
                self.measures.require_none(table)
            except ValueError:
                # the version before is in force again
                remove(self.spark, newest(self.spark, self.place(table)))
                raise
        return written

    def _sliced(self, table: str) -> str | None:
        """Path of the newest version of a table, if it is one of periods."""
        path = newest(self.spark, self.place(table))
        return path if path and PERIOD in read_periods(self.spark, path, []).columns else None

    def rows_of(self, table: str, key: str, among: DataFrame) -> DataFrame:
        """The rows of a table that have a key of ``among`` (key), and their period.

        The periods are found by the key column alone; only their files are read.
        """
        path = self._sliced(table)
        return read_periods(self.spark, path, periods_of(self.spark, path, key, among)).join(among, key, "left_semi")

    def _changes(self, table: str, delta: DataFrame, unset: str | None = None) -> DataFrame:
        """Changed rows, stored and counted: what is merged is neither computed twice nor read from what it replaces.

        ``unset`` is a column that new rows get later.
        """
        checks = {(table, "change", op): F.count_if(F.col(OP) == op) for op in (INSERT, UPDATE)}
        delta = self.measures.watch(delta, {**checks, **row_checks(table, [name for name in delta.columns if name != unset])})
        stored = write_snapshot(delta, f"{self.root}/changes/{table}", keep_period=True)
        if self.enforce:
            self.measures.require_none(table)
        return stored

    def replace_all(self, tables: Tables) -> Tables:
        return each(self.spark, {name: lambda n=name, d=df: self.replace(n, d) for name, df in tables.items()})

    def prune(self, tables: list[str], keep: int = 2) -> None:
        for table in tables:
            drop_old_versions(self.spark, self.place(table), keep)

    def staging(self) -> Tables:
        found = {name: self.current(name) for name in STAGING}
        return {name: df for name, df in found.items() if df is not None}

    def load_dimensions(self, staging: Tables, duplicate_nk: str = "error", touched: DataFrame | None = None) -> Tables:
        """Bring every dimension up to date with staging; what has not changed is not written.

        With ``touched`` (idunico) only these projects are compared with the project dimension.
        """

        def job(dimension):
            def load() -> DataFrame:
                if dimension is PROJECT:
                    return self._load_projects(staging[dimension.source], duplicate_nk, touched)
                found = members(dimension, staging[dimension.source], duplicate_nk)
                before = self.current(dimension.table)
                if before is None:
                    return self.replace(dimension.table, load_dimension(dimension, found))
                changed = self._changed_members(dimension, found, before)
                if changed.isEmpty():
                    return before
                return self.replace(dimension.table, load_dimension(dimension, changed, before))

            return load

        return each(self.spark, {dimension.table: job(dimension) for dimension in DIMENSIONS})

    def _changed_members(self, dimension, found: DataFrame, before: DataFrame) -> DataFrame:
        """Members that are new or have other attributes, stored."""
        names = list(dimension.columns)
        known = before.select(dimension.nk, F.struct(*names).alias("_old"))
        new = F.col("_old").isNull()
        rows = found.join(known, dimension.nk, "left").filter(new | ~F.col("_old").eqNullSafe(F.struct(*names)))
        return self._changes(dimension.table, rows.select(*found.columns, F.when(new, INSERT).otherwise(UPDATE).alias(OP))).drop(OP)

    def _load_projects(self, staging: DataFrame, duplicate_nk: str, touched: DataFrame | None) -> DataFrame:
        """The project dimension, changed in the periods that lose or get a project."""
        path = self._sliced(PROJECT.table)
        if path is None:
            found = members(PROJECT, staging, duplicate_nk)
            return self.replace(PROJECT.table, load_dimension(PROJECT, found, self.current(PROJECT.table)))
        if touched is None:
            found, before = members(PROJECT, staging, duplicate_nk), read_snapshot(self.spark, self.place(PROJECT.table), keep_period=True)
        else:
            found = members(PROJECT, self.rows_of(PARENT_TABLE, "idunico", touched).drop(PERIOD), duplicate_nk)
            before = self.rows_of(PROJECT.table, PROJECT.nk, touched.withColumnRenamed("idunico", PROJECT.nk))
        known = before.select(PROJECT.nk, PROJECT.sk)
        now = with_period(found.join(known, PROJECT.nk, "left"), "data_projeto", self.grain)
        delta = self._changes(PROJECT.table, changed_rows(before.select(*now.columns), now, [PROJECT.nk]), PROJECT.sk)
        added = delta.filter(F.col(OP) == INSERT).drop(PROJECT.sk)
        if not added.isEmpty():
            numbered = assign_surrogates(added, PROJECT.nk, PROJECT.sk, self.current(PROJECT.table).select(PROJECT.sk))
            delta = write_snapshot(delta.filter(F.col(OP) == UPDATE).unionByName(numbered), f"{self.root}/changes/numbered", keep_period=True)
        merge_periods(path, delta, [PROJECT.nk])
        return self.current(PROJECT.table)

    def load_facts(
        self,
        tables: Tables,
        on_duplicate: str = "error",
        strict_counts: bool = True,
        touched: DataFrame | None = None,
    ) -> Tables:
        """Bring every fact up to date with staging and dimensions; what has not changed is not written.

        With ``touched`` (idunico, periodo) the rows of these projects are computed again and compared with those stored; periodo is
        where a project's rows were before. Files of other periods are neither read nor written.
        """
        if touched is None:
            projects = with_period(tables[PROJECT.table], "data_projeto", self.grain)
            held = None
        else:
            keys = touched.select("idunico").distinct()
            read = {name for name in [PARENT_TABLE, FUNDING_TABLE, *[bridge.source for bridge in BRIDGES]] if name in tables}
            staged = each(self.spark, {name: lambda n=name: self.rows_of(n, "idunico", keys).drop(PERIOD) for name in read})
            spent = F.col("idProjetoInvestimento")
            booked = tables[EXECUTION_TABLE].join(keys.select(F.col("idunico").alias("idProjetoInvestimento")), "idProjetoInvestimento", "left_semi")
            projects = self.rows_of(PROJECT.table, PROJECT.nk, keys.withColumnRenamed("idunico", PROJECT.nk))
            projects = write_snapshot(projects.select(PROJECT.nk, PROJECT.sk, PERIOD), f"{self.root}/changes/projects", keep_period=True)
            tables = {**tables, **staged, EXECUTION_TABLE: booked.filter(spent.isNotNull()), PROJECT.table: projects.drop(PERIOD)}
            # one value per period concerned reaches the driver
            held = [row[0] for row in touched.select(PERIOD).union(projects.select(PERIOD)).distinct().collect()]
        place = projects.select(PROJECT.sk, PERIOD)

        specs = {MAIN_FACT: (lambda: project_fact(tables, strict_counts), [PROJECT.sk])}
        specs[FUNDING_FACT] = (lambda: unique_funding(funding_fact(tables), on_duplicate), [PROJECT.sk, FUNDING.sk])
        for bridge in BRIDGES:
            specs[bridge.table] = (lambda b=bridge: bridge_fact(b, tables), bridge.keys)

        def job(table, build, keys):
            def load() -> DataFrame:
                path = self._sliced(table)
                if path is None:
                    # the first load, or one of a version without periods
                    return self.replace(table, load_fact(build(), keys, self.current(table)).join(place, PROJECT.sk))
                if held is None:
                    before = read_snapshot(self.spark, self.place(table), keep_period=True)
                else:
                    before = read_periods(self.spark, path, held).join(place.select(PROJECT.sk), PROJECT.sk, "left_semi")
                after = load_fact(build(), keys, before.drop(PERIOD)).join(place, PROJECT.sk)
                merge_periods(path, self._changes(table, changed_rows(before, after, keys)), keys)
                return self.current(table)

            return load

        return each(self.spark, {table: job(table, *spec) for table, spec in specs.items()})

    def clean(self, staging: Tables) -> Tables:
        """Write staging without its repeated rows."""
        return self.replace_all(dedupe_staging(staging))

    def clean_in_place(self, fresh: Tables | None = None) -> Tables:
        """Remove repeated rows from stored staging, rewriting only the partitions that hold any.

        With ``fresh``, the rows just added, only their keys (of execution rows, their files) are searched.
        """

        def job(name):
            rows = (fresh or {}).get(name)
            if fresh is not None and rows is None:
                return self.current(name)
            if name == EXECUTION_TABLE:
                among = None if rows is None else rows.select(LINEAGE)
                remove_copies(self.spark, self.place(name), LINEAGE, among=among)
            elif name in STAGING_KEYS:
                keys = STAGING_KEYS[name]
                remove_copies(self.spark, self.place(name), PERIOD, keys, None if rows is None else rows.select(keys))
            return self.current(name)

        return each(self.spark, {name: lambda n=name: job(n) for name in self.staging()})

    def refresh(
        self,
        staging: Tables | None = None,
        duplicate_nk: str = "error",
        spent: list[str] | None = None,
        **fact_options,
    ) -> Tables:
        """De-duplicate staging, then load dimensions, then facts.

        Given ``staging`` is written clean; the stored one is cleaned in place. All rows are compared; a reload that knows what it
        touched is ``run_by_date``. ``spent`` names folders that only the given staging is read from: they are removed once it is written.
        """
        staged = self.clean(staging) if staging else self.clean_in_place()
        for folder in spent or []:
            remove(self.spark, folder)
        dims = self.load_dimensions(staged, duplicate_nk)
        facts = self.load_facts({**staged, **dims}, **fact_options)
        remove(self.spark, f"{self.root}/changes")
        return {**staged, **dims, **facts}

    def touched(self, fresh: Tables, window: Window, execution: DataFrame, files: list, records: DataFrame | None = None) -> DataFrame:
        """(idunico, periodo) of the projects whose rows a reload by date may change, asked before it.

        They are those of the fresh rows, of stored rows in the window, and those whose booked sum differs once the named files of
        execution rows are replaced. periodo is where the project's facts are now, null also if it has none. ``records`` (idunico) holds
        the keys of all fresh rows, if they can be had for less than from every table.
        """
        first, last = period_of(window.first, self.grain), period_of(window.last, self.grain)
        keys = [rows.select("idunico") for rows in fresh.values()] if records is None else [records]
        for name in fresh:
            path = self._sliced(name)
            if path is not None:
                stored = read_periods(self.spark, path, list(range(first, last + 1)))
                keys.append(stored.filter(window.contains(F.col("datacadastro"))).select("idunico"))
        key, booked = F.col("idProjetoInvestimento").alias("idunico"), money_sum(F.col("valorEmpenho"))
        after = execution.groupBy(key).agg(booked.alias("after"))
        before = self.current(EXECUTION_TABLE)
        if before is None:
            keys.append(after.select("idunico"))
        else:
            before = before.filter(F.col(LINEAGE).isin(files)).distinct().groupBy(key).agg(booked.alias("before"))
            sums = before.join(after, "idunico", "full_outer")
            keys.append(sums.filter(differs(F.col("before"), F.col("after"))).select("idunico"))
        found = reduce(DataFrame.union, keys).filter("idunico is not null").distinct()
        path = self._sliced(PROJECT.table)
        if path is None:
            return found.withColumn(PERIOD, F.lit(None).cast("int"))
        places = read_snapshot(self.spark, self.place(PROJECT.table), keep_period=True).select(F.col(PROJECT.nk).alias("idunico"), PERIOD)
        return found.join(places, "idunico", "left")

    def append(self, fresh: Tables) -> Tables:
        """Add the rows that staging tables do not hold yet, without removing any."""

        def job(name, rows):
            path = newest(self.spark, self.place(name))
            if path is None:
                return self.replace(name, rows)
            dated = with_period(rows, "datacadastro", self.grain)
            add_missing(dated, path)
            return self.current(name)

        return each(self.spark, {name: lambda n=name, r=rows: job(n, r) for name, rows in fresh.items()})

    def reload_by_date(self, fresh: Tables, as_of: date, days: int, legacy_window: bool = False) -> Tables:
        """Replace the trailing window of every staging table by fresh rows.

        The same window is deleted and loaded; ``legacy_window`` also deletes the rows
        of ``as_of`` itself.
        """
        window = (legacy_delete_window if legacy_window else trailing_window)(as_of, days)

        def job(name, rows):
            if newest(self.spark, self.place(name)) is None:
                return self.replace(name, rows)
            replace_window(rows, self.place(name), "datacadastro", window, self.grain)
            return self.current(name)

        return each(self.spark, {name: lambda n=name, r=rows: job(n, r) for name, rows in fresh.items()})

    def reload_by_state(self, fresh: Tables, states: list[str]) -> Tables:
        """Replace the parent rows of the given states and all child rows of their projects.

        Only the periods that hold such rows, or get fresh ones, are written again. The children go first:
        if a run fails, the parents still name what has to go, and it can be repeated.
        """
        parent = self.current(PARENT_TABLE)
        if parent is None:
            return self.replace_all(fresh)
        of_states = F.col("uf").isin(states)
        doomed = doomed_keys(parent, "idunico", of_states)

        def job(name: str, rows: DataFrame) -> DataFrame:
            path = newest(self.spark, self.place(name))
            if path is None:
                return self.replace(name, rows)
            if name == PARENT_TABLE:
                replace_where(rows, path, of_states, "datacadastro", self.grain)
            else:
                replace_by_key(rows, path, doomed, "idunico", "datacadastro", self.grain)
            return self.current(name)

        children = {name: rows for name, rows in fresh.items() if name != PARENT_TABLE}
        # each shuffles a whole table twice, once by its keys and once by its periods
        done = each(self.spark, {name: lambda n=name, r=rows: job(n, r) for name, rows in children.items()}, at_once=2)
        if PARENT_TABLE in fresh:
            done[PARENT_TABLE] = job(PARENT_TABLE, fresh[PARENT_TABLE])
        return done

    def reload_execution(self, fresh: DataFrame, years: list | None = None) -> DataFrame:
        """Replace the execution rows of every file year in ``fresh``, all in one job.

        ``years`` names all that were extracted: those without a row are emptied.
        """
        path = newest(self.spark, self.place(EXECUTION_TABLE))
        if path is None:
            return self.replace(EXECUTION_TABLE, fresh)
        overwrite_partitions(fresh, path, LINEAGE, years)
        return self.current(EXECUTION_TABLE)

    def finish(self, run: str, tables: list[str]) -> None:
        """Drop the landed copy of a run and all but the two newest versions of the tables."""
        for folder in (run, "changes"):
            remove(self.spark, f"{self.root}/{folder}")
        self.prune(tables)


def run_by_date(
    warehouse: Warehouse, nested: DataFrame, execution: DataFrame, as_of: date, days: int,
    duplicate_nk: str = "error", years: list | None = None, run: str | None = None, **fact_options,
) -> Tables:
    """Reload the trailing window from landing records, then refresh dimensions and facts.

    The work follows what was loaded: copies are searched for among the fresh keys, and only the facts of touched projects are computed
    and compared; periods without a change keep their files. The first load of an empty warehouse is written without copies, and its
    facts are those of all rows. ``years`` names the file years that were extracted, also those without
    a row. Inputs are read once, into the run's folder.

    A run that died is repaired by repeating it: the projects it was to touch are on record. Repeated under the same ``run`` name it
    goes on after its last finished step, with the records it had landed.
    """
    spark, root = warehouse.spark, f"{warehouse.root}/run"
    ledger = Ledger(spark, root, run)
    # not so for a run that died once it had written a table: it goes on as a reload
    first = warehouse.is_empty()
    warehouse.measures = Measures(spark)
    landed = ledger.table("landed", lambda: warehouse.measures.watch(nested, landing_checks(nested)))
    fresh = normalize(landed)
    booked = ledger.table("execution", lambda: execution)
    window = trailing_window(as_of, days)
    # one value per file year reaches the driver
    files = list({*[str(year) for year in years or []], *[row[0] for row in booked.select(LINEAGE).distinct().collect()]})
    touched = warehouse.touched(fresh, window, booked.distinct(), files, landed.select(F.col("idUnico").alias("idunico")))
    # a step that is on record has changed what the question is asked of
    found = ledger.table("touched", lambda: ledger.pending("touched", touched))

    loaded = {**fresh, EXECUTION_TABLE: booked}
    added = dedupe_staging(loaded) if first else loaded
    ledger.step("staging", lambda: warehouse.reload_by_date({name: added[name] for name in fresh}, as_of, days))
    ledger.step("execution", lambda: warehouse.reload_execution(added[EXECUTION_TABLE], years))
    # what was written without copies has none to search for
    ledger.step("clean", lambda: warehouse.clean_in_place({} if first else loaded))
    staged = warehouse.staging()
    keys = found.select("idunico").distinct()
    ledger.step("dimensions", lambda: warehouse.load_dimensions(staged, duplicate_nk, keys))
    dims = {dimension.table: warehouse.current(dimension.table) for dimension in DIMENSIONS}
    facts: Tables = {}
    ledger.step("facts", lambda: facts.update(warehouse.load_facts({**staged, **dims}, touched=None if first else found, **fact_options)))
    built = {**staged, **dims, **(facts or {table: warehouse.current(table) for table in FACTS})}
    ledger.finish()
    warehouse.finish("run", list(built))
    return built


def load_execution(spark: SparkSession, folder: str, years: list, skip_missing: bool = False) -> DataFrame:
    """Execution rows of the landed files ``<year>.json``, with the year they came from as their lineage.

    A year that was never landed is an error unless ``skip_missing``; a file without a record gives no row, so that a
    reload by these years empties it.
    """
    absent = [year for year in years if not matching(spark, f"{folder}/{year}.json")]
    if absent and not skip_missing:
        raise FileNotFoundError(f"no landed file for the years {absent} below {folder}")
    return read_chosen_json(spark, folder, years, EXECUTION_LANDING).withColumn(LINEAGE, file_lineage())


def load_report(nested: DataFrame, root: str) -> DataFrame:
    """(check, name, rows): what a load leaves out: texts that are no dates, and rows without a natural key.

    Counted while the records are landed below ``root``, by the write itself. One row for each date column of the records
    and for each dimension, zero if nothing is left out.
    """
    measures = Measures(nested.sparkSession)
    land_columnar(nested, root, measures)
    found = measures.report().filter(F.col("check").isin("no date", "no natural key"))
    name = F.when(F.col("check") == "no date", F.col("column")).otherwise(F.col("table"))
    return found.select("check", name.alias("name"), "rows")


def run_by_state(
    warehouse: Warehouse, nested: DataFrame, states: list[str], only: set[str] | None = None
) -> Tables:
    """Reload the projects of the given states; dimensions and facts are left alone."""
    warehouse.measures = Measures(warehouse.spark)
    fresh = load_staging(nested, f"{warehouse.root}/run", only=only, measures=warehouse.measures)
    done = warehouse.reload_by_state(fresh, states)
    warehouse.finish("run", list(done))
    return done
