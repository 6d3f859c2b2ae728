"""Legacy grant expressions: object type, object name, privilege translation."""

from functools import reduce

from pyspark.sql import Column, functions as F

from grantline.fixed import PRIVILEGE_MAP, PRIVILEGES_NOT_ALLOWED_ON


def object_type(catalog: Column, database: Column, table: Column, view: Column) -> Column:
    return (
        F.when(F.coalesce(table, view).isNotNull(), "TABLE")
        .when(database.isNotNull(), "SCHEMA")
        .when(catalog.isNotNull(), "CATALOG")
        .otherwise("UNKNOWN")
    )


def object_name(catalog: Column, database: Column, table: Column, view: Column) -> Column:
    """Dotted name; a view is named like a table."""
    return F.concat_ws(".", catalog, database, F.coalesce(table, view))


def _text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lookup(entries: dict[str, int], key: str, default: int) -> str:
    """A number by name.  The map is a constant, so the generated code stays small."""
    if not entries:
        return f"{default}L"
    pairs = ", ".join(f"{_text(name)}, {number}L" for name, number in entries.items())
    return f"coalesce(try_element_at(map({pairs}), {key}), {default}L)"


class PrivilegeSet:
    """Sets of new privileges held as bit masks.

    A set is one or more ``bigint`` columns, so that the union over a group is ``bit_or``: a plain
    hash aggregate with an eight-byte buffer that combines before the shuffle, whatever the number
    of rows of the group.  :meth:`names` turns the masks back into an array.
    """

    BITS = 62

    def __init__(self, mapping=None, not_allowed=None):
        self.mapping = PRIVILEGE_MAP if mapping is None else mapping
        self.not_allowed = PRIVILEGES_NOT_ALLOWED_ON if not_allowed is None else not_allowed
        # Descending, the order in which privileges are listed.
        self._names = sorted({p for new in self.mapping.values() for p in new}, reverse=True)
        words = -(-len(self._names) // self.BITS)
        self.columns = [f"privilege_bits_{n}" for n in range(max(words, 1))]

    def _mask(self, names, word: int) -> int:
        chosen = self._names[word * self.BITS : (word + 1) * self.BITS]
        return sum(1 << bit for bit, name in enumerate(chosen) if name in names)

    def is_mapped(self, action: str) -> Column:
        return F.coalesce(F.upper(action).isin(list(self.mapping)), F.lit(False))

    def of_action(self, action: str) -> list[Column]:
        """Masks of the legacy privilege in a column; an unmapped one has the empty set."""

        def bits(word: int) -> str:
            entries = {old: self._mask(new, word) for old, new in self.mapping.items()}
            return _lookup(entries, f"upper({action})", 0)

        return [F.expr(bits(n)).alias(c) for n, c in enumerate(self.columns)]

    def allowed_on(self, kind: str) -> list[Column]:
        """Masks without the privileges that the object type in a column does not know."""

        def kept(word: int) -> str:
            everything = self._mask(self._names, word)
            entries = {
                name: everything & ~self._mask(removed, word)
                for name, removed in self.not_allowed.items()
            }
            return _lookup(entries, kind, everything)

        return [F.expr(f"{c} & {kept(n)}").alias(c) for n, c in enumerate(self.columns)]

    def union(self) -> list[Column]:
        return [F.bit_or(c).alias(c) for c in self.columns]

    def not_empty(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c) != 0 for c in self.columns])

    def _members(self) -> str:
        """Each privilege's name where the set has it, else NULL; in descending order."""

        def member(position: int, name: str) -> str:
            word, bit = divmod(position, self.BITS)
            return f"if({self.columns[word]} & {1 << bit}L <> 0, {_text(name)}, null)"

        return ", ".join(member(n, name) for n, name in enumerate(self._names)) or "null"

    def names(self) -> Column:
        """The set as an array of names."""
        return F.expr(f"array_compact(array({self._members()}))").cast("array<string>")

    def quoted(self) -> Column:
        """The set as ``["A","B"]``."""
        return F.expr(f"""concat('["', concat_ws('","', {self._members()}), '"]')""")
