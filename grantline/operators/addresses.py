"""Block addresses that do not repeat.

A block's address is made of labels, and different names may have the same label.  Every name that needs
it gets a mark behind its label: the first eight, or all 32, hexadecimal digits of the MD5 of its key.

Which names need a mark is decided for all names at once, without repeated rounds, since the decision
does not depend on which others are marked:

* names whose plain label is shared;
* names whose plain label is what another name's would be with a mark (whether or not that one has it);
* names that a joined address confuses with others (see ``confused_labels``).

So no plain label equals a marked one.  Marks of eight digits that two names would share become long
ones; two marked labels then end in different marks, or in marks of different length, and differ.
"""

from pyspark.sql import Column, DataFrame, functions as F

SHORT = 8


def _keyed(names: DataFrame, keys: list[str], stem: Column) -> DataFrame:
    rows = names.select(*keys, stem.alias("_stem")).distinct()
    digest = F.md5(F.concat_ws("\n", *keys))
    return rows.withColumns({"_digest": digest, "_short": F.substring(digest, 1, SHORT)})


def _with_marks() -> list[Column]:
    return [F.concat_ws("_", "_stem", mark) for mark in ("_short", "_digest")]


def unique_labels(
    names: DataFrame, keys: list[str], stem: Column, out: str, confused: DataFrame | None = None
) -> DataFrame:
    """``keys`` and the column ``out``: a label for each key that no other key has.

    ``stem`` is the plain label.  ``confused`` has further keys to be marked (see ``confused_labels``).
    ``names`` is read three times: it should be a table, or cheap.
    """
    rows = _keyed(names, keys, stem)

    def token(value: Column | str, role: str) -> Column:
        return F.struct((F.col(value) if isinstance(value, str) else value).alias("token"), F.lit(role).alias("role"))

    tokens = rows.select(
        F.inline(F.array(token("_stem", "plain"), token("_short", "mark"), *[token(c, "marked") for c in _with_marks()]))
    )
    counted = tokens.groupBy("token").agg(
        *[F.count_if(F.col("role") == role).alias(role) for role in ("plain", "marked", "mark")]
    )
    shared = counted.filter("plain > 1 OR plain = 1 AND marked > 0").select(F.col("token").alias("_stem"), F.lit(True).alias("_shared"))
    long = counted.filter("mark > 1").select(F.col("token").alias("_short"), F.lit(True).alias("_long"))
    rows = rows.join(shared, "_stem", "left").join(long, "_short", "left")
    marked = F.col("_shared").isNotNull()
    if confused is not None:
        rows = rows.join(confused.select(*keys).distinct().withColumn("_confused", F.lit(True)), keys, "left")
        marked = marked | F.col("_confused").isNotNull()
    mark = F.when(F.col("_long").isNull(), F.col("_short")).otherwise(F.col("_digest"))
    return rows.select(*keys, F.when(marked, F.concat_ws("_", "_stem", mark)).otherwise(F.col("_stem")).alias(out))


def _splits(label: str) -> Column:
    """(head, tail) for each underscore of a label with something on both sides of it."""
    return F.expr(f"""
        filter(transform(sequence(1, greatest(length({label}), 1)), i -> struct(
                 if(substring({label}, i, 1) = '_', left({label}, i - 1), '') AS head,
                 substring({label}, i + 1) AS tail)),
               s -> s.head <> '' AND s.tail <> '')""")


def confused_labels(first_labels: DataFrame, first: str, seconds: DataFrame, keys: list[str], stem: Column) -> DataFrame:
    """Keys of ``seconds`` that need a mark so that no two addresses ``first_second`` are equal.

    ``first`` is a column of unique labels.  ``p_x`` before ``l`` and ``p`` before ``x_l`` give the same
    address, so labels of the second sort are looked at that differ by such an ``x`` in front.  The plain
    ones that would meet a plain longer one, or one with a mark, are returned.
    """
    heads = first_labels.select(first)
    between = (
        heads.select(F.inline(_splits(first)))
        .join(heads.withColumnRenamed(first, "head"), "head", "left_semi").select(F.col("tail").alias("_x")).distinct()
    )
    rows = _keyed(seconds, keys, stem)
    plain = rows.select(*keys, F.col("_stem").alias("_label"), F.lit(True).alias("_plain"))
    marked = rows.select(*keys, F.explode(F.array(*_with_marks())).alias("_label"), F.lit(False).alias("_plain"))
    labels = plain.unionByName(marked)
    # Few names, if any, are one another's beginning, so this join leaves little of the labels' splits.
    longer = labels.select(
        *[F.col(c).alias(f"_long_{c}") for c in keys], F.col("_plain").alias("_long_plain"), F.inline(_splits("_label"))
    ).join(between, F.col("head") == F.col("_x"), "left_semi")
    met = labels.join(longer, F.col("_label") == F.col("tail"))
    other = ~F.array(*[F.col(c).cast("string") for c in keys]).eqNullSafe(F.array(*[F.col(f"_long_{c}").cast("string") for c in keys]))
    met = met.filter(other & (F.col("_plain") | F.col("_long_plain")))
    shorter = met.filter("_plain").select(*keys)
    own = met.filter("NOT _plain").select(*[F.col(f"_long_{c}").alias(c) for c in keys])
    return shorter.unionByName(own).distinct()
