"""Every operator as a query over the given tables, with an independent SQL form of its result."""

from pulsepanel.plans.checked.base import REGISTRY, Checked
from pulsepanel.plans.checked import (  # noqa: F401  (registration)
    axis,
    correcting,
    estimating,
    forecasting,
    loading,
    summing,
    whole_countries,
)

__all__ = ["REGISTRY", "Checked"]
