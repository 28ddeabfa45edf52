"""Declarative descriptions of a panel and of one raw source."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    """Shape of a wide panel: one row per key, one column per source metric.

    ``entity`` and ``period`` are the composite key; ``name`` is the optional
    display label carried next to the entity; ``labels`` maps metric column to
    a human label used by coverage reports.
    """

    entity: str
    period: str
    metrics: tuple[str, ...]
    name: str | None = None
    labels: dict = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    def label(self, metric: str) -> str:
        return self.labels.get(metric, metric)


@dataclass(frozen=True)
class SourceSpec:
    """How one raw source is read and cleaned into ``[entity, period, metric]``.

    Every field may be None: a cleaner step whose column is not configured
    (or absent in the data) is skipped, as in the per-source scripts.
    """

    label: str
    path: str | None
    metric: str                     # output metric column name
    fmt: str = "csv"                # csv | json-payload | positional | parquet
    raw_metric: str | None = None   # column holding the value
    raw_code: str | None = None     # column holding the entity code
    raw_name: str | None = None     # column holding the entity name
    raw_period: str | None = None   # column holding the period
    encoding: str | None = None     # preferred encoding, None = detect
    keep_name: bool = False         # carry the name column into the panel
    exclude_code_prefix: str | None = None
    equals_filters: tuple = ()      # ((column, value), ...) applied if column present
    cascade: tuple | None = None    # (column, (pref1, pref2, ...))
    drop_null_metric: bool = False  # True also drops rows whose value is missing
    correct_names: bool = False     # apply corrections + resolve name -> code
    on_duplicate: str | None = None  # None | mean | first
    positional: tuple | None = None  # (skip_rows, period_pos, value_pos, const_code)
    optional: bool = False          # True: a missing file leaves the source out; else it is an error
