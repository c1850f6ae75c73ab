"""panelops: monthly-panel analytics as Spark DataFrame operators."""

from panelops.spec import BILLING, PanelSpec, Scenario

__all__ = ["BILLING", "PanelSpec", "Scenario"]
