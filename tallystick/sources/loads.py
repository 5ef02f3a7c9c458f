"""Checked, repeatable loads: rejected lines are set aside, loaded files are remembered.

A load writes every table's accepted rows to a folder of its own, ``<table>/load=<id>``, and
ends with one line per file in the ledger. Tables are read from the loads the ledger names, so
a load that breaks midway is invisible, whichever table it broke at. A file whose name and
content the ledger knows for a table is skipped, so loading it again changes nothing. One load
at a time may run on a store.

Lines are refused for what a constrained database refuses: text that is no row of the table,
a broken value rule, a value without a row in the table it refers to, a repeated key. Stored
rows and those of the same load count alike; tables are loaded parents first. Of several new rows with
one key the first in the order of their columns stays, provided that it breaks no other kind of
rule; a row refused for one repeated key still stands in the way of others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallystick.operators.quality import row_rules
from tallystick.sources.delimited import TableStore, csv_options, read_moment
from tallystick.sources.tables import SPECS, Tables, TableSpec, spec_of
from tallystick.sources.workspace import staged

LEDGER = "load string, loaded_at string, `table` string, file string, checksum string, lines long"
REJECTED = ["table", "rule", "value", "file", "line"]
_CORRUPT = "_corrupt"
_FOUND = "array<struct<rule:string,value:string>>"


@dataclass
class Load:
    """What a load did: per table the lines read, accepted and rejected; files known before;
    and every rejected line with each rule it broke (one row per line and rule)."""

    id: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    rejected: DataFrame | None = None


class LoadStore(TableStore):
    """Input tables made of committed loads below one root."""

    @property
    def _ledger(self) -> str:
        return f"{self.root}/ledger"

    def loads(self) -> DataFrame:
        """One row per loaded file."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._ledger)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).json(self._ledger)

    def table(self, table_name: str) -> DataFrame:
        spec = spec_of(table_name)
        return self._rows(spec, self._committed(spec))

    def _committed(self, spec: TableSpec) -> list[str]:
        known = self.loads().where(F.col("table") == spec.name).select("load").distinct()
        return sorted(r["load"] for r in known.collect())

    def _rows(self, spec: TableSpec, loads: list[str]) -> DataFrame:
        schema = spec.schema(self.money)
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self._load_folder(spec, load) for load in loads))

    def _load_folder(self, spec: TableSpec, load: str) -> str:
        return f"{self._folder(spec.name)}/load={load}"

    def import_data(self, table_name: str, file_path: str, delimiter: str = "\t", multiline: bool = False) -> Load:
        """A load of one table. Line breaks inside fields are not admitted."""
        if multiline:
            raise ValueError("a checked load reads line by line")
        return self.load({table_name: file_path}, delimiter)

    def load_all(self, folder: str, mini: bool = True, delimiter: str = "\t") -> Load:
        """The eight shipped files as one load: all of them become visible, or none."""
        files = {}
        for name, spec in SPECS.items():
            small = "_Mini" if mini and name != "analysis_formation" else ""
            files[name] = f"{folder.rstrip('/')}/{spec.file_stem}{small}.tsv"
        return self.load(files, delimiter)

    def load(self, files: Mapping[str, str], delimiter: str = "\t") -> Load:
        """Load files or folders into tables, given by name or alias, in one commit."""
        asked = {spec_of(name).name: path for name, path in files.items()}
        done = Load(uuid.uuid4().hex)
        entries, rejected = [], []
        written: set[str] = set()
        for name, spec in SPECS.items():
            if name not in asked:
                continue
            new = self._new_files(spec, asked[name], done)
            if not new:
                continue
            tagged, counts = self._tagged(spec, [file for file, _, _ in new], delimiter)
            broken = self._broken_keys(spec, tagged, written, done.id)
            sound = tagged.where(F.size("found") == 0)
            accepted = sound.join(broken.select("id").distinct(), "id", "left_anti").select(*(c.name for c in spec.columns))
            kept = Observation()
            accepted.observe(kept, F.count(F.lit(1)).alias("rows")).write.parquet(self._load_folder(spec, done.id))
            written.add(name)
            each = F.explode("found").alias("f")
            refused = tagged.where(F.size("found") > 0).select("file", "line", each).select("f.rule", "f.value", "file", "line")
            late = tagged.select("id", "file", "line").join(broken, "id").select("rule", "value", "file", "line")
            rejected.append(refused.unionByName(late).select(F.lit(name).alias("table"), "rule", "value", "file", "line"))
            rows = kept.get["rows"]
            done.counts[name] = {"lines": counts, "accepted": rows, "rejected": counts - rows}
            now = dt.datetime.now(dt.timezone.utc).isoformat()
            entries += [(done.id, now, name, file, checksum, lines) for file, checksum, lines in new]
        if rejected:
            done.rejected = reduce(DataFrame.unionByName, rejected)
        if entries:
            self._commit(entries)
        return done

    def _commit(self, entries: list[tuple]) -> None:
        """One file, moved into place when it is whole: the load is visible from here on."""
        self.spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").json(self._ledger)

    def _new_files(self, spec: TableSpec, path: str, done: Load) -> list[tuple[str, str, int]]:
        """(file, checksum, lines) of the files that the ledger does not know.

        The checksum is free of order, so one pass without a shuffle of lines makes it.
        """
        hashed = F.xxhash64("value")
        sums = (
            self.spark.read.text(path)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(hashed.cast("decimal(38,0)")).alias("s"), F.bit_xor(hashed).alias("x"))
            .select("file", F.concat_ws("/", "lines", "s", "x").alias("checksum"), "lines")
        )
        known = self.loads().where(F.col("table") == spec.name).select("file", "checksum").distinct().withColumn("known", F.lit(True))
        found = sums.join(known, ["file", "checksum"], "left").orderBy("file").collect()
        done.skipped += [r["file"] for r in found if r["known"]]
        return [(r["file"], r["checksum"], r["lines"]) for r in found if not r["known"]]

    def _tagged(self, spec: TableSpec, files: list[str], delimiter: str) -> tuple[DataFrame, int]:
        """Every line with its typed columns, an id, and the rules it breaks by itself."""
        schema = spec.schema(self.money, as_text=True).add(_CORRUPT, "string")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        options = csv_options(delimiter) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        lines = self.spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
        cut = lines.where(F.trim("line") != "").withColumn("row", F.from_csv("line", ddl, options)).select("file", "line", "row.*")
        typed = cut.select(
            "file",
            "line",
            _CORRUPT,
            *(read_moment(F.col(c.name)).alias(c.name) if c.kind == "moment" else F.col(c.name) for c in spec.columns),
            *(F.col(c.name).alias(f"_{c.name}") for c in spec.columns if c.kind == "moment"),
        )
        rules: list[tuple[str, Expr, Expr]] = [
            (f"{c.name} is a date", F.col(c.name).isNull() & (F.trim(f"_{c.name}") != ""), F.col(f"_{c.name}"))
            for c in spec.columns
            if c.kind == "moment"
        ]
        rules += [rule for c in spec.columns for rule in row_rules(c)]
        if spec.primary_key:
            rules.append((f"{spec.primary_key} primary key", F.col(spec.primary_key).isNull(), F.lit(None)))
        broken = F.array_compact(
            F.array(*(F.when(bad, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value"))) for rule, bad, value in rules))
        )
        whole = F.array(F.struct(F.lit("row of the table").alias("rule"), F.lit(None).cast("string").alias("value")))
        found = F.when(F.col(_CORRUPT).isNotNull(), whole).otherwise(broken).cast(_FOUND)
        read = Observation()
        tagged = typed.withColumn("found", found).withColumn("id", F.monotonically_increasing_id())
        tagged = tagged.select("id", "file", "line", "found", *(c.name for c in spec.columns))
        kept = staged(tagged.observe(read, F.count(F.lit(1)).alias("lines")), "lines")
        return kept, read.get["lines"]

    def _broken_keys(self, spec: TableSpec, tagged: DataFrame, written: set[str], load: str) -> DataFrame:
        """(id, rule, value) of lines that are sound by themselves, but refer to nothing or repeat a key."""
        sound = tagged.where(F.size("found") == 0)
        columns = [c.name for c in spec.columns]

        def known(table: str, key: str) -> DataFrame:
            of = SPECS[table]
            loads = self._committed(of) + ([load] if table in written else [])
            return self._rows(of, loads).select(F.col(key).alias("key"))

        def broken(rows: DataFrame, rule: str) -> DataFrame:
            return rows.select("id", F.lit(rule).alias("rule"), F.col("key").cast("string").alias("value"))

        dangling = [
            broken(sound.withColumn("key", F.col(ref.column)).where("key is not null").join(known(ref.table, ref.key), "key", "left_anti"), f"{ref.column} in {ref.table}")
            for ref in spec.references
        ]
        nothing = broken(tagged.limit(0).withColumn("key", F.lit(None)), "")
        missing = staged(reduce(DataFrame.unionByName, dangling, nothing), "dangling")
        keys = ([(spec.primary_key, "primary key")] if spec.primary_key else []) + [(c, "unique") for c in spec.unique]
        if not keys:
            return missing
        rest = sound.join(missing.select("id").distinct(), "id", "left_anti").select("id", *columns)
        found = missing
        for column, kind in keys:
            # A group is reduced to its first row before the rows meet it again.
            rows = rest.withColumn("key", F.col(column)).where("key is not null")
            first = rows.groupBy("key").agg(F.min(F.struct(*columns, "id")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
            again = rows.join(first.select("key", F.col("first.id").alias("stays")), "key").where(F.col("id") != F.col("stays"))
            stored = rows.join(known(spec.name, column).distinct(), "key", "left_semi")
            both = again.select("id", "key").unionByName(stored.select("id", "key")).distinct()
            found = found.unionByName(broken(both, f"{column} {kind}"))
        return staged(found, "keys")

    def tables(self) -> Tables:
        return Tables(**{name: self.table(name) for name in SPECS})
