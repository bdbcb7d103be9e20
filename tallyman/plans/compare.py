"""One comparison from sources to results."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyman.config import CompareConfig
from tallyman.operators import differences, drift, duplicates, summary
from tallyman.sources import sinks, specs
from tallyman.sources.tables import compared_columns, input_files, sides


@dataclass
class Comparison:
    """Lazy results of a comparison.

    Nothing runs until a result is used, but for one aggregate over both sides
    that finds constant columns (none with prune_constants=False).
    """

    ref: DataFrame
    new: DataFrame
    config: CompareConfig

    @cached_property
    def columns(self) -> list[str]:
        return compared_columns(self.ref, self.new, self.config)

    @cached_property
    def tagged(self) -> DataFrame:
        """Both sides' rows in one form, of which differences, summary and constants are made."""
        return differences.prepared(self.ref, self.new, self.config, self.columns)

    @cached_property
    def pruned(self) -> list[str]:
        """The compared columns without constants: found once for differences and summary."""
        return differences.pruned_columns(self.tagged, self.config, self.columns)

    @cached_property
    def differences(self) -> DataFrame:
        return differences.differences(self.tagged, self.config, self.columns, self.pruned)

    @cached_property
    def key_flags(self) -> DataFrame:
        return differences.key_flags(self.tagged, self.config, self.columns, self.pruned)

    @cached_property
    def duplicates(self) -> DataFrame:
        if not self.config.check_duplicates:
            return duplicates.no_duplicates(self.ref.sparkSession)
        return duplicates.duplicates(self.ref, self.new, self.config, self.columns)

    @cached_property
    def summary(self) -> DataFrame:
        return summary.summary(self.key_flags, self.config)

    @cached_property
    def schema_report(self) -> drift.SchemaReport:
        return drift.analyze(self.ref, self.new)

    @cached_property
    def lossy_casts(self) -> DataFrame:
        """How many values of NEW are lost or changed by the cast to REF's type, for each column of another type."""
        return drift.lossy_casts(self.ref, self.new)

    def input_files(self) -> tuple[int, int]:
        return input_files(self.ref), input_files(self.new)

    def write(self, path: str, initiative: str, date: str, files: int | None = None) -> None:
        """All results as Parquet below path."""
        for kind, result, parts in (("differences", self.differences, files), ("duplicates", self.duplicates, files), ("summary", self.summary, 1)):
            sinks.write_path(result, path, kind, initiative, date, parts)

    def write_tables(self, prefix: str, initiative: str, date: str, location: str | None = None, files: int | None = None) -> None:
        """All results into the catalog's result tables."""
        sinks.create_tables(self.ref.sparkSession, prefix, location)
        for kind, result, parts in (("differences", self.differences, files), ("duplicates", self.duplicates, files), ("summary", self.summary, 1)):
            sinks.write_table(result, prefix, kind, initiative, date, parts)


def compare(spark: SparkSession, ref: DataFrame | str, new: DataFrame | str, keys: list[str] | tuple[str, ...], **options) -> Comparison:
    """Compares two DataFrames, tables or Parquet paths on a composite key; options as in CompareConfig."""
    fields = {k: tuple(v) if isinstance(v, list) else v for k, v in options.items()}
    config = CompareConfig(tuple(keys), **fields)
    return Comparison(*sides(spark, ref, new, config), config)


def config_of_parameters(parameters: dict[str, str]) -> tuple[dict, CompareConfig]:
    """(refTable, newTable, initiativeName, tablePrefix, outputBucket, executionDate, output date) and the configuration, from key=value parameters."""
    needed = ("refTable", "newTable", "initiativeName", "tablePrefix", "outputBucket", "executionDate", "compositeKeyCols")
    missing = [k for k in needed if not (parameters.get(k) or "").strip()]
    if missing:
        raise ValueError(f"missing parameters: {', '.join(missing)}")
    listed = lambda k: tuple(x.strip() for x in (parameters.get(k) or "").split(",") if x.strip())
    true = lambda k: (parameters.get(k) or "").strip().lower() == "true"
    day = parameters["executionDate"]
    common = specs.normalize_spec(parameters.get("partitionSpec"), day)
    date_column = parameters.get("dateColumn") or "data_date_part"

    def side(name: str) -> str | None:
        direct = specs.normalize_spec(parameters.get(f"{name}PartitionSpec"), day)
        spec = specs.side_spec(direct, parameters.get(f"{name}WindowDays"), common, day, date_column)
        return None if spec == common else spec

    config = CompareConfig(
        keys=listed("compositeKeyCols"),
        ignore=listed("ignoreCols"),
        spec=common,
        ref_spec=side("ref"),
        new_spec=side("new"),
        ref_filter=parameters.get("refFilter") or None,
        new_filter=parameters.get("newFilter") or None,
        mapping={k.removeprefix("colMap."): v for k, v in parameters.items() if k.startswith("colMap.")},
        priority=listed("priorityCols") or listed("priorityCol")[:1],
        overrides={k.removeprefix("agg."): v for k, v in parameters.items() if k.startswith("agg.")},
        null_keys_match=(parameters.get("nullKeyMatches") or "true").strip().lower() != "false",
        include_equals=true("includeEqualsInDiff"),
        check_duplicates=true("checkDuplicates"),
    )
    return {k: parameters[k] for k in needed} | {"outputDate": day, "files": None if true("enableDynamicPartitioning") else 1}, config


def parameters_of_json(text: str, execution_date: str | None = None) -> dict[str, str]:
    """key=value parameters from a JSON payload: `parameters` or the whole object, dates rewritten."""
    tree = specs.parse_json(text)
    raw = tree.get("parameters", tree)
    day = execution_date or raw.get("executionDate")
    if not day:
        raise ValueError("missing parameters: executionDate")
    done, spec = specs.normalize_parameters({k: v for k, v in raw.items() if k != "executionDate"}, day)
    out: dict[str, str] = {"executionDate": day}
    for k, v in done.items():
        if k == "aggOverrides" and isinstance(v, dict):
            out |= {f"agg.{c}": str(how) for c, how in v.items()}
        elif k == "columnMapping" and isinstance(v, dict):
            out |= {f"colMap.{a}": str(b) for a, b in v.items()}
        elif isinstance(v, list):
            out[k] = ",".join(map(str, v))
        elif isinstance(v, bool):
            out[k] = str(v).lower()
        elif v is not None and not isinstance(v, dict):
            out[k.replace("PartitionSpecOverride", "PartitionSpec")] = str(v)
    return out | ({"partitionSpec": spec} if spec else {})


def parse_arguments(args: list[str]) -> dict[str, str]:
    """Parameters from `key=value` arguments (quotes around a value go, if they are a pair) or a JSON object."""
    if args and args[0].lstrip().startswith("{"):
        return parameters_of_json(args[0])
    pairs = [a.partition("=") for a in args]
    return {k.strip(): specs.unquoted(v) for k, eq, v in pairs if eq and k.strip()}
