"""What one comparison is to do."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Names of aggregation overrides, and what they stand for.
OVERRIDES = {"max": "max", "min": "min", "first_non_null": "first", "first": "first", "firstnonnull": "first", "first-non-null": "first"}


@dataclass(frozen=True)
class CompareConfig:
    """One comparison of a trusted table (REF) with a candidate (NEW).

    keys: columns of the composite key, in REF's vocabulary.
    ignore: columns that are not compared.
    spec, ref_spec, new_spec: partition specs; a side's own one takes the place of the common one.
    ref_filter, new_filter: Spark SQL predicates, applied before renaming.
    mapping: REF name -> NEW name.
    priority: columns whose greatest values choose the row of a key (nulls last).
    overrides: column -> max, min or first_non_null (default: max).
    first_order: columns that order the rows for first_non_null; without any, the order is Spark's.
    null_keys_match: whether null keys meet null keys.
    include_equals: whether MATCH and EXACT_MATCH rows are kept.
    prune_constants: leave out columns that hold one equal value on both sides.
    null_aware_constants: a column with nulls is no constant.
    samples, sample_seed: how many ids the summary shows, and the seed that draws them at random (default: the least ids).
    """

    keys: tuple[str, ...]
    ignore: tuple[str, ...] = ()
    spec: str | None = None
    ref_spec: str | None = None
    new_spec: str | None = None
    ref_filter: str | None = None
    new_filter: str | None = None
    mapping: dict[str, str] = field(default_factory=dict)
    priority: tuple[str, ...] = ()
    overrides: dict[str, str] = field(default_factory=dict)
    first_order: tuple[str, ...] = ()
    null_keys_match: bool = True
    include_equals: bool = False
    prune_constants: bool = True
    null_aware_constants: bool = False
    check_duplicates: bool = True
    samples: int = 10
    sample_seed: int | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a comparison needs at least one key column")
        if len(set(self.keys)) != len(self.keys):
            raise ValueError(f"key columns repeat: {', '.join(self.keys)}")
        unknown = {v for v in self.overrides.values() if v.strip().lower() not in OVERRIDES}
        if unknown:
            raise ValueError(f"unknown aggregation overrides: {', '.join(sorted(unknown))}")
        if len(set(self.mapping.values())) != len(self.mapping):
            raise ValueError("two columns are mapped to the same column")

    def override(self, column: str) -> str:
        return OVERRIDES[self.overrides.get(column, "max").strip().lower()]
