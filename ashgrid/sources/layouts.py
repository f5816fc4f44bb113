"""The yearly table layouts and how their columns map to ours.

A layout is recognised by its header line only; an unknown header is an
error, never a guess (one ``read.csv`` over mixed layouts would silently
apply one file's header to all files by position).
"""

from __future__ import annotations

from dataclasses import dataclass

# Header lines of the yearly tables, in file order.
HEADERS = {
    "L1": ("ind", "UC", "Bioma", "Area_queimada", "Area_UC", "Perc_UC", "Data_ult_atual"),
    "L2": ("ind", "UC", "Bioma", "Area_queimada", "Area_UC", "Perc_UC", "Data_ult_atual",
           "Satelite"),
    "L3": ("ind", "UC", "Bioma", "Incendio", "MIF", "Area_queimada", "Area_UC", "Perc_UC",
           "Data_ult_atual", "Satelite"),
    "L4": ("", "UC", "Bioma", "Fogo_natural", "Queima_indig_isol", "Incendio",
           "Queima_controlada", "Queima_prescrita", "Gestao_raio", "Aceiro_negro",
           "Area_queimada", "Area_UC", "`Perc_UC", "Data_ult_atual", "Satelite"),
    "L5": ("ind", "UC", "Incendio", "Queima_prescrita", "Queima_controlada", "Aceiro",
           "Fogo_natural", "Queima_indigena", "Raio", "Area_total", "Area_UC", "Perc_AAF_UC"),
    "L6": ("ind", "UC", "NGI", "Incendio", "Queima_prescrita", "Queima_controlada", "Aceiro",
           "Fogo_natural", "Indigena_isolado", "Total_prevencao", "Total_combate", "Area_total",
           "Area_UC", "Perc_AAF_UC"),
    "LT": ("AREA_QUEIM_ANO", "ano"),
}

# Header name -> our column name (cause columns keep their
# raw name behind the CAUSE_PREFIX so the raw cause stays recoverable).
RENAME = {
    "ind": "src_row",
    "": "src_row",
    "UC": "unit_raw",
    "Bioma": "biome_raw",
    "NGI": "mgmt_group_raw",
    "Area_queimada": "area_total",
    "Area_total": "area_total",
    "Area_UC": "area_unit",
    "Perc_UC": "pct_published",
    "`Perc_UC": "pct_published",
    "Perc_AAF_UC": "pct_published",
    "Data_ult_atual": "last_update_raw",
    "Satelite": "sensor_raw",
    "Total_prevencao": "prevention_published",
    "Total_combate": "combat_published",
    "AREA_QUEIM_ANO": "area_total",
    "ano": "yr",
}
CAUSE_PREFIX = "cause__"

# The cause columns across layouts.
CAUSE_HEADERS = ("Incendio", "MIF", "Fogo_natural", "Queima_indig_isol", "Queima_controlada",
                 "Queima_prescrita", "Gestao_raio", "Aceiro_negro", "Aceiro",
                 "Queima_indigena", "Raio", "Indigena_isolado")

DOUBLE_COLUMNS = ("area_total", "area_unit", "pct_published", "prevention_published",
                  "combat_published")
INT_COLUMNS = ("src_row", "yr")


@dataclass(frozen=True)
class Layout:
    id: str
    header: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(CAUSE_PREFIX + h if h in CAUSE_HEADERS else RENAME[h] for h in self.header)

    @property
    def cause_columns(self) -> tuple[str, ...]:
        return tuple(CAUSE_PREFIX + h for h in self.header if h in CAUSE_HEADERS)

    def types(self) -> dict[str, str]:
        t = {}
        for c in self.columns:
            if c in DOUBLE_COLUMNS or c.startswith(CAUSE_PREFIX):
                t[c] = "double"
            elif c in INT_COLUMNS:
                t[c] = "int"
        return t


LAYOUTS = {k: Layout(k, v) for k, v in HEADERS.items()}


def parse_header(line: str) -> tuple[str, ...]:
    return tuple(f.strip() for f in line.rstrip("\r\n").split(","))


def detect_layout(header_line: str) -> Layout:
    """Layout whose header equals this line exactly (after trimming)."""
    fields = parse_header(header_line)
    for lay in LAYOUTS.values():
        if lay.header == fields:
            return lay
    raise ValueError(f"unknown layout, header {fields!r}")
