"""Labels, quoting and templates."""

from string import Formatter

from pyspark.sql import Column, functions as F

from grantline.fixed import LABEL_FORBIDDEN_PATTERN


def label(name: Column) -> Column:
    """A block label: forbidden characters become ``_``, letters become lower case."""
    return F.lower(F.regexp_replace(name, LABEL_FORBIDDEN_PATTERN, "_"))


def escape(value: Column) -> Column:
    """Escape a value for a double-quoted string of the document language."""
    replacements = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("${", "$${"), ("%{", "%%{")]
    for plain, escaped in replacements:
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def render(template: str, **values: Column) -> Column:
    """Fill the ``{name}`` slots of a format text with columns."""
    pieces = []
    for text, slot, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if slot:
            pieces.append(values[slot])
    return F.concat(*pieces)
