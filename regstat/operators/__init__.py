"""DataFrame -> DataFrame operators of the register statistics job."""

from regstat.operators import checks, episodes, places, residence, tabulate

__all__ = ["checks", "episodes", "places", "residence", "tabulate"]
