"""The decoding algebra: from a cell to a value plus the errors met on the way.

A decoder never runs by itself. It builds two columns, the value and an array of errors, and
Spark evaluates them over the whole table. Errors of the fields of a record add up; elements of
a list stop at the first failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.cells import Cell, Record, show, with_variant
from graphloom.model import ERRORS_DDL

# Error texts (fixed values).
MISSING_RECORD = "A record was expected but none was received"
KEY_ERROR = "Error decoding key: '{}'"
NOT_FOUND = "Field '{}' not found"
COULD_NOT_DECODE = "Couldn't decode {} into a {}"
FOR_FIELD = " for field '{}'"
MANY_ERRORS = "Multiple decoding errors:\n"


def no_errors() -> Column:
    return F.array().cast(ERRORS_DDL)


def error(kind: str, message: Column, field: str | None = None) -> Column:
    """An error array with one entry."""
    one = F.struct(F.lit(kind).alias("kind"), F.lit(field).alias("field"), message.alias("message"))
    return F.array(one).cast(ERRORS_DDL)


def error_text(errors: Column) -> Column:
    """One message: the single error's own text, or all texts one per line."""
    texts = F.transform(errors, lambda e: e["message"])
    return F.when(F.size(errors) == 1, texts[0]).when(
        F.size(errors) > 1, F.concat(F.lit(MANY_ERRORS), F.array_join(texts, "\n"), F.lit("\n"))
    )


@dataclass(frozen=True)
class Decoded:
    """``value`` is meaningful on the rows where ``errors`` is empty."""

    value: Column
    errors: Column
    packed: Column | None = None
    # Whether the value is null exactly on the rows that have errors.
    null_if_bad: bool = False

    @property
    def ok(self) -> Column:
        return self.value.isNotNull() if self.null_if_bad else F.size(self.errors) == 0

    @property
    def settled(self) -> Column:
        """The value, null where there are errors."""
        return self.value if self.null_if_bad else F.when(self.ok, self.value)

    def column(self) -> Column:
        """Value and errors as one struct."""
        if self.packed is not None:
            return self.packed
        return F.struct(self.value.alias("value"), self.errors.alias("errors"))


class Decoder:
    """``accepts`` names the kinds taken; a decoder built from others leaves it out."""

    def __init__(self, run: Callable[[Cell], Decoded], accepts: tuple[str, ...] | None = None):
        self._run = run
        self._accepts = accepts

    def __call__(self, cell: Cell) -> Decoded:
        if self._accepts is not None and cell.is_variant:
            # Decoding asks a VARIANT for its kind and content many times over. Holding both in a
            # lambda variable keeps the expression small and computes them once.
            return unpack(with_variant(cell.col, self._accepts, lambda bound: self._run(bound).column()))
        return self._run(cell)

    def map(self, fn: Callable[[Column], Column]) -> "Decoder":
        """Apply a total function to the value."""

        def run(cell: Cell) -> Decoded:
            d = self(cell)
            if d.null_if_bad:
                return Decoded(F.when(d.value.isNotNull(), fn(d.value)), d.errors)
            return Decoded(fn(d.value), d.errors)

        return Decoder(run)

    def emap(self, fn: Callable[[Column], tuple[Column, Column]], kind: str = "incoercible") -> "Decoder":
        """Apply a function that may fail: it returns the new value and a message, null when fine."""

        def run(cell: Cell) -> Decoded:
            d = self(cell)
            value, message = fn(d.value)
            return Decoded(
                value,
                F.when(~d.ok, d.errors).when(message.isNotNull(), error(kind, message)).otherwise(no_errors()),
            )

        return Decoder(run)

    def ensure(
        self, test: Callable[[Column], Column], message: Callable[[Column], Column], kind: str = "incoercible"
    ) -> "Decoder":
        """Keep the value only where the test holds; a test or message that is null is a failure too."""
        unknown = F.lit("The predicate does not hold for null")
        return self.emap(
            lambda v: (v, F.when(~F.coalesce(test(v), F.lit(False)), F.coalesce(message(v), unknown))), kind
        )

    def transform(self, fn: Callable[[Decoded], Decoded]) -> "Decoder":
        """See success or failure and return either, so failures can be recovered."""
        return Decoder(lambda cell: fn(self(cell)))

    def flat_map(
        self, choose: Callable[[Column], Sequence[tuple[Column, "Decoder"]]], otherwise: "Decoder"
    ) -> "Decoder":
        """Pick the next decoder from this one's value; it decodes the same cell."""

        def run(cell: Cell) -> Decoded:
            first = self(cell)
            branches = [(cond, nxt(cell)) for cond, nxt in choose(first.value)]
            rest = otherwise(cell)
            value, errors = rest.value, rest.errors
            for cond, d in reversed(branches):
                value = F.when(cond, d.value).otherwise(value)
                errors = F.when(cond, d.errors).otherwise(errors)
            return Decoded(value, F.when(first.ok, errors).otherwise(first.errors))

        return Decoder(run)

    def and_(self, other: "Decoder") -> "Decoder":
        """Both on the same cell; the errors of both are kept."""
        return combine({"left": self, "right": other})

    def or_(self, other: "Decoder") -> "Decoder":
        """The other one where this fails; both errors where both fail."""

        def run(cell: Cell) -> Decoded:
            a, b = self(cell), other(cell)
            errors = F.when(a.ok | b.ok, no_errors()).otherwise(F.concat(a.errors, b.errors))
            return Decoded(F.when(a.ok, a.value).otherwise(b.value), errors)

        return Decoder(run)


def unpack(packed: Column) -> Decoded:
    return Decoded(packed["value"], packed["errors"], packed)


def constant(value: Column) -> Decoder:
    return Decoder(lambda cell: Decoded(value, no_errors()))


def failed(message: Callable[[Cell], Column] | str, kind: str = "incoercible", ddl: str = "void") -> Decoder:
    def run(cell: Cell) -> Decoded:
        text = F.lit(message) if isinstance(message, str) else message(cell)
        return Decoded(F.lit(None).cast(ddl), error(kind, text))

    return Decoder(run)


def combine(parts: dict[str, Decoder], into: Callable[..., Column] | None = None) -> Decoder:
    """Several decoders on the same cell, into a struct or a function; all errors are merged."""

    def run(cell: Cell) -> Decoded:
        return merge({name: d(cell) for name, d in parts.items()}, into)

    return Decoder(run)


def merge(parts: dict[str, Decoded], into: Callable[..., Column] | None = None) -> Decoded:
    values = [d.value for d in parts.values()]
    value = into(*values) if into else F.struct(*[v.alias(n) for v, n in zip(values, parts)])
    return Decoded(value, F.concat(*[d.errors for d in parts.values()]))


# A case of a match: the kind it takes and what to do with the typed cell. The function returns
# the value, or the value and a message for the rows on which the value is null.
Case = tuple[str, Callable[[Cell], Column | tuple[Column, Column]]]


def from_match(type_name: str, ddl: str, cases: Sequence[Case]) -> Decoder:
    """Decode by kind. A one-key map is tried as its only value first, then as itself."""

    def run(cell: Cell) -> Decoded:
        branches: list[tuple[Column, Column, Column]] = []
        partial = []
        sole = cell.sole()
        tries = ([sole] if sole else []) + [(None, cell)]
        for guard, target in tries:
            for kind, fn in cases:
                if not target.may_be(kind):
                    continue
                test = target.holds(kind)
                outcome = fn(target.read(kind))
                value, message = outcome if isinstance(outcome, tuple) else (outcome, None)
                value = value.cast(ddl)
                bad = no_errors() if message is None else error("incoercible", message)
                errors = bad if message is None else F.when(value.isNotNull(), no_errors()).otherwise(bad)
                branches.append((test if guard is None else guard & test, value, errors))
                partial.append((value, bad, message is not None))
        fail = could_not_decode(cell, type_name)
        if len(branches) == 1 and partial[0][2]:
            # A typed column that is parsed. Asking for the value first, on every row, lets Spark
            # compute it once for the value and the errors together.
            value, bad, _ = partial[0]
            errors = F.when(value.isNotNull(), no_errors()).when(branches[0][0], bad).otherwise(fail)
            return Decoded(value, errors, null_if_bad=True)
        return choose_first(branches, F.lit(None).cast(ddl), fail)

    return Decoder(run, tuple(kind for kind, _ in cases))


def could_not_decode(cell: Cell, type_name: str) -> Column:
    before, after = COULD_NOT_DECODE.format("\0", type_name).split("\0")
    return error("incoercible", F.concat(F.lit(before), show(cell), F.lit(after)))


def choose_first(branches: list[tuple[Column, Column, Column]], value: Column, errors: Column) -> Decoded:
    for test, v, e in reversed(branches):
        value = F.when(test, v).otherwise(value)
        errors = F.when(test, e).otherwise(errors)
    return Decoded(value, errors)


# -- over a whole table ----------------------------------------------------------------------
def decode(df: DataFrame, decoder: Decoder, keep: Sequence[str] = (), cell: Cell | None = None) -> DataFrame:
    """One row in, one row out: the kept columns, ``value`` and ``errors``."""
    d = decoder(cell if cell is not None else Record(df.schema))
    return df.select(*keep, d.settled.alias("value"), d.errors.alias("errors"))


def strict(decoded: DataFrame) -> DataFrame:
    """All rows decoded, or the job stops with the first bad row's message."""
    value = F.when(F.size("errors") == 0, F.col("value")).otherwise(F.raise_error(error_text(F.col("errors"))))
    return decoded.withColumn("value", value).drop("errors")


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantine with the errors of each bad row."""
    settled = settle(decoded)
    good = settled.where(F.size("errors") == 0).drop("errors")
    quarantine = settled.where(F.size("errors") > 0).drop("value")
    return good, quarantine


def settle(decoded: DataFrame) -> DataFrame:
    """Hold value and errors as they were computed.

    A filter on ``errors`` would otherwise be rewritten in terms of the raw columns and decode every
    row a second time. It is not moved below a one-element ``inline``.
    """
    keep = [c for c in decoded.columns if c not in ("value", "errors")]
    return decoded.select(*keep, F.inline(F.array(F.struct("value", "errors"))))


def error_report(decoded: DataFrame) -> DataFrame:
    """How often each kind of error was met, per field and message."""
    return (
        decoded.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.kind").alias("kind"), F.col("e.field").alias("field"), F.col("e.message").alias("message"))
        .agg(F.count("*").alias("n"))
    )
