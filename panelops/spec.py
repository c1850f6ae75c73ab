"""Names of the columns an operator works on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a measurement panel. The key is never assumed unique."""

    time: str
    keys: tuple[str, ...]
    target: str
    exposure: str
    year: str = "anio"
    month: str = "mes"

    @property
    def panel_key(self) -> tuple[str, ...]:
        return (self.time, *self.keys)


@dataclass(frozen=True)
class Scenario:
    """One feature set over one view of the panel."""

    label: str
    view: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]


BILLING = PanelSpec(
    time="fecha",
    keys=("region", "comuna", "tipo_clientes", "tarifa"),
    target="energia_kwh",
    exposure="clientes_facturados",
)
