"""Schema drift: reported, never enforced."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

MOST_DIFFERENCES, MOST_MOVES = 100, 50
REPORT = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "column", "ref", "new", "severity")])


@dataclass(frozen=True)
class FieldDifference:
    column: str
    ref_type: str
    new_type: str
    ref_nullable: bool
    new_nullable: bool
    metadata_differs: bool

    @property
    def severity(self) -> str:
        if self.ref_type != self.new_type:
            return "critical"
        return "moderate" if self.ref_nullable != self.new_nullable else "minimal"


@dataclass(frozen=True)
class SchemaReport:
    ref_columns: int
    new_columns: int
    only_ref: list[str] = field(default_factory=list)
    only_new: list[str] = field(default_factory=list)
    differences: list[FieldDifference] = field(default_factory=list)
    moves: list[str] = field(default_factory=list)
    total_differences: int = 0
    total_moves: int = 0

    @property
    def identical(self) -> bool:
        return not (self.only_ref or self.only_new or self.total_differences or self.total_moves)

    def rows(self) -> list[tuple]:
        flag = lambda b: str(b).lower()
        rows = [("only_in_ref", c, c, None, "moderate") for c in self.only_ref]
        rows += [("only_in_new", c, None, c, "moderate") for c in self.only_new]
        for d in self.differences:
            if d.ref_type != d.new_type:
                rows.append(("type", d.column, d.ref_type, d.new_type, "critical"))
            if d.ref_nullable != d.new_nullable:
                rows.append(("nullable", d.column, flag(d.ref_nullable), flag(d.new_nullable), "moderate"))
            if d.metadata_differs:
                rows.append(("metadata", d.column, None, None, "minimal"))
        return rows + [("order", m.split("@")[0], *m.split("@")[1].split(">"), "minimal") for m in self.moves]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), REPORT)


def _field_differences(ref: T.StructType, new: T.StructType) -> list[FieldDifference]:
    other = {f.name: f for f in new}
    found = []
    for f in ref:
        g = other.get(f.name)
        if g is not None and (f.dataType != g.dataType or f.nullable != g.nullable or f.metadata != g.metadata):
            found.append(FieldDifference(f.name, f.dataType.simpleString(), g.dataType.simpleString(), f.nullable, g.nullable, f.metadata != g.metadata))
    return found


def compare_schemas(ref: DataFrame, new: DataFrame) -> tuple[list[str], list[str], list[FieldDifference]]:
    """Columns that NEW lacks, columns that REF lacks, and differences of the shared ones."""
    return [c for c in ref.columns if c not in new.columns], [c for c in new.columns if c not in ref.columns], _field_differences(ref.schema, new.schema)


def analyze(ref: DataFrame, new: DataFrame, most: int = MOST_DIFFERENCES, most_moves: int = MOST_MOVES) -> SchemaReport:
    """compare_schemas with changed places; lists are cut to the given lengths, totals are whole."""
    only_ref, only_new, found = compare_schemas(ref, new)
    place = {c: i for i, c in enumerate(new.columns)}
    moves = [f"{c}@{i}>{place[c]}" for i, c in enumerate(ref.columns) if c in place and place[c] != i]
    return SchemaReport(len(ref.columns), len(new.columns), only_ref, only_new, found[:most], moves[:most_moves], len(found), len(moves))


def lossy_casts(ref: DataFrame, new: DataFrame) -> DataFrame:
    """column, lost, changed (one aggregate): how many values of NEW become null when cast to REF's type, and how many come back from it as another value."""
    kinds = {f.name: f.dataType for f in ref.schema}
    plain = lambda kind: not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    shared = [f for f in new.schema if f.name in kinds and f.dataType != kinds[f.name] and plain(f.dataType) and plain(kinds[f.name])]
    cells = []
    for f in shared:
        value, cast = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(kinds[f.name])
        back = cast.try_cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            # texts of one value may differ (1 and 01): what counts is whether the number is the same
            same = value.try_cast("decimal(38,10)").eqNullSafe(cast.try_cast("decimal(38,10)")) if isinstance(kinds[f.name], T.NumericType) else F.lit(True)
        else:
            same = back.eqNullSafe(value)
        lost = value.isNotNull() & cast.isNull()
        cells.append(F.struct(F.lit(f.name).alias("column"), F.count_if(lost).alias("lost"), F.count_if(cast.isNotNull() & ~same).alias("changed")))
    if not cells:
        return new.sparkSession.createDataFrame([], "column string, lost long, changed long")
    return new.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def log_report(report: SchemaReport) -> None:
    log.info("schema: %d columns in REF, %d in NEW%s", report.ref_columns, report.new_columns, ", identical" if report.identical else "")
    for kind, column, ref, new, severity in report.rows():
        level = logging.INFO if severity == "minimal" else logging.WARNING
        log.log(level, "schema %s (%s): %s REF=%s NEW=%s", kind, severity, column, ref, new)
    for what, total, shown in (("differences", report.total_differences, len(report.differences)), ("moves", report.total_moves, len(report.moves))):
        if total > shown:
            log.info("schema: %d more %s", total - shown, what)
