"""Reading tables: which source table holds which metric columns."""

from __future__ import annotations

from dataclasses import dataclass

# Table names, metric columns, status codes and plausible ranges.
TABLES = {
    "co": ("co_minutales", ["co_mean"]),
    "nox": ("nox_minutales", ["no_mean", "no2_mean", "nox_mean"]),
    "pm10": ("pm10_minutales", ["pm10_mean"]),
    "so2": ("so2_minutales", ["so2_mean"]),
    "o3": ("o3_minutales", ["o3_mean"]),
    "meteo": (
        "meteo_minutales",
        ["dv_mean", "vv_mean", "temp_mean", "hr_mean", "pa_mean", "uv_mean", "lluvia_mean", "rs_mean"],
    ),
}
VALID_STATUS = "k"
STATUS_DOMAIN = ["k", "v", "s", "m"]
METRIC_RANGES = {
    "co": {"co_mean": (0, 100)},
    "nox": {"no_mean": (0, 500), "no2_mean": (0, 500), "nox_mean": (0, 1000)},
    "pm10": {"pm10_mean": (0, 1000)},
    "so2": {"so2_mean": (0, 500)},
    "o3": {"o3_mean": (0, 500)},
}
# End of fixed values.

ALL_COLUMNS = ("*",)


@dataclass(frozen=True)
class ReadingTable:
    """One wide table of minute readings."""

    key: str
    table: str
    metrics: tuple[str, ...]


class Catalog:
    """Lookup of reading tables by key; an unknown key fails before any job runs."""

    def __init__(self, tables: dict[str, tuple[str, list[str]]] | None = None):
        entries = TABLES if tables is None else tables
        self._tables = {key: ReadingTable(key, name, tuple(metrics)) for key, (name, metrics) in entries.items()}

    @property
    def keys(self) -> list[str]:
        return list(self._tables)

    def __getitem__(self, key: str) -> ReadingTable:
        try:
            return self._tables[key]
        except KeyError:
            raise KeyError(f"unknown reading table {key!r}; available: {self.keys}") from None

    def select(self, keys: list[str] | None = None) -> list[ReadingTable]:
        """The named tables, or all of them when ``keys`` is None or empty."""
        return [self[key] for key in (keys or self.keys)]
