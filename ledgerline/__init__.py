"""Contract-driven table loading and summaries on Spark."""

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract, load_contract
from ledgerline.errors import ContractViolation

__all__ = ["LENIENT", "STRICT", "ColumnSpec", "Contract", "ContractViolation", "load_contract"]
