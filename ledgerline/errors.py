"""Errors a load can end with."""


class ContractViolation(ValueError):
    """The incoming columns do not fit the declared contract."""
