"""Declared column contracts: which source columns a table takes and what they become.

A contract is small driver-side metadata. Two policies read the same contract:

* ``lenient`` - a cell that cannot be converted becomes NULL;
* ``strict``  - a cell that cannot be converted, or does not fit its declared
  length or precision, ends the query with an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerline.errors import ContractViolation

LENIENT = "lenient"
STRICT = "strict"
POLICIES = (LENIENT, STRICT)
KINDS = ("string", "int", "decimal", "epoch", "point")

POINT_TYPE = T.StructType(
    [
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    return policy


def quoted(name: str) -> str:
    """A column name as a back-ticked SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class ColumnSpec:
    """One contract column.

    ``length`` limits text, ``precision`` limits the digits of ``int`` and
    ``decimal`` columns; ``scale`` is the digits after the point of a decimal.
    """

    source: str
    target: str
    kind: str = "string"
    length: int | None = None
    precision: int | None = None
    scale: int = 0

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ContractViolation(f"column {self.target!r}: unknown kind {self.kind!r}")
        if self.kind == "decimal" and self.precision is None:
            raise ContractViolation(f"column {self.target!r}: a decimal needs a precision")

    def data_type(self, policy: str) -> T.DataType:
        """The column's DataFrame type under a policy."""
        check_policy(policy)
        if self.kind == "int":
            return T.IntegerType() if policy == LENIENT else T.DecimalType(self.precision or 38, 0)
        if self.kind == "decimal":
            return T.DecimalType(self.precision, self.scale)
        if self.kind == "epoch":
            return T.TimestampNTZType()
        if self.kind == "point" and policy == STRICT:
            return POINT_TYPE
        return T.StringType()

    def sql_type(self, policy: str) -> str:
        """The column's type in a CREATE TABLE statement."""
        data_type = self.data_type(policy)
        if isinstance(data_type, T.StringType) and self.length is not None and policy == STRICT:
            return f"VARCHAR({self.length})"
        return data_type.simpleString()


@dataclass(frozen=True)
class Contract:
    """An ordered set of columns, with the layout and comment of their table."""

    name: str
    columns: tuple[ColumnSpec, ...]
    cluster_by: tuple[str, ...] = ()
    comment: str | None = None

    def __post_init__(self) -> None:
        for side in ("sources", "targets"):
            folded = [name.lower() for name in getattr(self, side)]
            twice = sorted({name for name in folded if folded.count(name) > 1})
            if twice:
                raise ContractViolation(f"contract {self.name!r}: repeated {side} {twice}")
        unknown = [key for key in self.cluster_by if key not in self.targets]
        if unknown:
            raise ContractViolation(f"contract {self.name!r}: cluster keys {unknown} are not columns")

    @property
    def sources(self) -> list[str]:
        return [spec.source for spec in self.columns]

    @property
    def targets(self) -> list[str]:
        return [spec.target for spec in self.columns]

    def schema(self, policy: str) -> T.StructType:
        """Schema of the typed table; every column is nullable."""
        return T.StructType([T.StructField(c.target, c.data_type(policy)) for c in self.columns])

    def source_schema(self) -> T.StructType:
        """All-string schema keyed by source name, for reading JSON objects."""
        return string_schema(self.sources)

    def select(self, targets: Iterable[str]) -> Contract:
        """The same contract cut down to some target columns."""
        wanted = set(targets)
        return Contract(
            self.name,
            tuple(c for c in self.columns if c.target in wanted),
            tuple(k for k in self.cluster_by if k in wanted),
            self.comment,
        )

    def to_json(self) -> str:
        return json.dumps(
            {
                "name": self.name,
                "comment": self.comment,
                "cluster_by": list(self.cluster_by),
                "columns": [asdict(c) for c in self.columns],
            }
        )

    @staticmethod
    def from_json(text: str) -> Contract:
        try:
            body = json.loads(text)
            return Contract(
                body["name"],
                tuple(ColumnSpec(**column) for column in body["columns"]),
                tuple(body.get("cluster_by") or ()),
                body.get("comment"),
            )
        except (KeyError, TypeError, json.JSONDecodeError) as err:
            raise ContractViolation(f"not a contract document: {err}") from err


def string_schema(names: Iterable[str]) -> T.StructType:
    """A nullable string column for every name, in order."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def load_contract(spark: SparkSession, path: str) -> Contract:
    """Read one contract document from any file system Spark can reach."""
    found = spark.read.text(path, wholetext=True).take(2)
    if len(found) != 1:
        raise ContractViolation(f"{path}: expected one contract document, found {len(found)}")
    return Contract.from_json(found[0].value)
