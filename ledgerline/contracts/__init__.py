"""Ready-made contracts."""

from ledgerline.contracts.vehicles import VEHICLES

__all__ = ["VEHICLES"]
