"""Scores of texts by a word bigram model with Katz backoff.

P(w | h) = d(c) c(h, w) / c(h) for a bigram that was seen c times, else a(h) P(w).  P(w) = d(c) c(w) / N for
a known word; what is left is the probability of the unknown word.  d is Good and Turing's discount for
counts up to five, found separately for words and bigrams.  a(h) = (1 - sum of the seen P(w | h)) /
(1 - sum of their P(w)), so every distribution sums to one exactly.  A history that was never seen backs
off to P(w) with a weight of one.

The tables are partitioned and never whole in one place.  Texts are dealt to blocks, and a block counts
its words once:

1. words: each block sends its distinct words to the partition of the word table that their hash falls in
   and gets back, for each, its number in the vocabulary and its count;
2. bigrams: each block sends its distinct bigrams, as pairs of word numbers with the words' counts and
   the documents they occur in, to the partition of the bigram table that holds their history;
   histories with so many tokens that they would outgrow a partition are divided by the second word;
3. evaluation: a partition adds up the counts of its bigrams, and has all it needs for the logarithms
   except the discounts, which depend on the counts of counts of all partitions, so it keeps the sums
   per document by count, and the histories of unseen bigrams with what their weight is made of;
4. with the discounts known, the sums of each block's documents are put together.
"""

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from grantline.llm.words import encoded, mixed, word_hashes
from grantline.sinks.shared import stage

#: Counts up to this one are discounted.
LARGEST = 5
_END = mixed(np.array([0x45], np.uint64))[0]
_PACKED = "bucket long, block long, data binary"


def _pack(**arrays) -> bytes:
    return zlib.compress(pickle.dumps(arrays, protocol=5), 1)


def _unpack(data: bytes) -> dict:
    return pickle.loads(zlib.decompress(data))


def _small(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type."""
    most = int(values.max(initial=0))
    return values.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(kind).max))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that go to one block, packed: texts are the largest part of what is shuffled."""
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        order = np.argsort(block, kind="stable")
        ids, train = batch.column("doc_id").to_pylist(), batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        texts = encoded(batch.column("text").to_pylist())
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1)).tolist()
        rows = [order[x:y] for x, y in zip(cuts, [*cuts[1:], len(order)])]
        packed = [_pack(doc_id=[ids[i] for i in r], train=train[r], texts=[texts[i] for i in r]) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array([int(block[r[0]]) for r in rows], pa.int64()), pa.array(packed, pa.binary())], ["block", "data"])


def _texts(rows: pd.DataFrame) -> tuple[list, np.ndarray, list[bytes]]:
    parts = [_unpack(data) for data in rows["data"]]
    return (
        [i for p in parts for i in p["doc_id"]], np.concatenate([p["train"] for p in parts]), [x for p in parts for x in p["texts"]]
    )


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """Partition of the word table: equal ranges of hashes, in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """d(0), ..., d(5) from n(1), ..., n(6): Good and Turing's, or 1 - 1 / 2r where their formula gives no
    proper discount."""
    r = np.arange(1, LARGEST + 1)
    n = counts_of_counts.astype(float)
    found = plain = 1 - 0.5 / r
    if (n > 0).all() and (LARGEST + 1) * n[LARGEST] != n[0]:
        common = (LARGEST + 1) * n[LARGEST] / n[0]
        found = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
    return np.concatenate([[1.0], np.where((found > 0) & (found < 1), found, plain)])


@dataclass
class Words:
    """What all blocks know of the word table: sizes, and the first number of each partition."""

    tokens: int
    distinct: int
    numbers: int
    first: np.ndarray
    discount: np.ndarray
    documents: int
    scale: float = 1.0
    left: float = 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the count of w; that of the unknown word for count 0."""
        if not self.tokens:
            return np.ones(len(counts))
        share = self.discount[np.where(counts <= LARGEST, counts, 0)] * counts / self.tokens * self.scale
        return np.where(counts > 0, share, self.left)

    def settle(self, seen: float) -> None:
        """``seen``: the sum of d(c) c / N over all known words.  Without a word that is discounted the
        unknown word gets 1 / (N + 1)."""
        if 1 - seen > 1e-12:
            self.scale, self.left = 1.0, 1 - seen
        else:
            self.left = 1.0 / (self.tokens + 1)
            self.scale = (1 - self.left) / max(seen, 1e-300)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's closed by the end, how many each has, and where each ends."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts + 1) - 1
    tokens = np.full(len(hashes) + len(counts), _END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside] = hashes
    return tokens, counts + 1, ends


def _requests(n_buckets: int):
    def requested(rows: pd.DataFrame) -> pd.DataFrame:
        _, learn, texts = _texts(rows)
        tokens, counts, _ = _tokens(texts)
        words, place = np.unique(tokens, return_inverse=True)
        train = np.repeat(learn, counts)
        n = np.bincount(place[train], minlength=len(words))
        bucket = _bucket(words, n_buckets)
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        block = int(rows["block"].iloc[0])
        out = [(b, block, _pack(words=words[x:y], n=_small(n[x:y])))
               for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        return pd.DataFrame(out, columns=["bucket", "block", "data"])

    return requested


def _hist(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, LARGEST + 2), minlength=LARGEST + 3)[1 : LARGEST + 2].astype(np.int64)


def _word_table(rows: pd.DataFrame) -> pd.DataFrame:
    """One partition of the word table: each block's words numbered and counted, and sums (block -1)."""
    asked = [_unpack(data) for data in rows["data"]]
    words, place = np.unique(np.concatenate([a["words"] for a in asked]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([a["n"] for a in asked]), minlength=len(words)).astype(np.int64)
    bucket = int(rows["bucket"].iloc[0])
    cuts = np.cumsum([0] + [len(a["words"]) for a in asked])
    out = [(bucket, int(block), _pack(place=_small(place[x:y]), n=_small(total[place[x:y]])))
           for block, x, y in zip(rows["block"], cuts, cuts[1:])]
    by_count = np.bincount(np.minimum(total, LARGEST + 1), weights=total, minlength=LARGEST + 2)
    out.append((bucket, -1, _pack(numbers=len(words), distinct=int((total > 0).sum()), hist=_hist(total), mass=by_count)))
    return pd.DataFrame(out, columns=["bucket", "block", "data"])


def _bigrams(words: Words, n_buckets: int):
    hot_tokens = max(1, words.tokens // (2 * n_buckets))

    def sent(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block = int(rows["block"].iloc[0])
        ids, train, texts = _texts(rows)
        tokens, lengths, ends = _tokens(texts)
        _, place = np.unique(tokens, return_inverse=True)
        answers = [(int(b), _unpack(d)) for b, d in sorted(zip(replies["bucket"], replies["data"]))]
        number = np.concatenate([words.first[b] + a["place"].astype(np.int64) for b, a in answers])[place]
        count = np.concatenate([a["n"].astype(np.int64) for _, a in answers])[place]
        n_texts = len(texts)
        owner = np.repeat(np.arange(n_texts), lengths)
        # Add-one smoothing over the known words and the unknown one.
        base = np.log10((count + 1) / (words.tokens + words.distinct + 1))
        known = count > 0
        # The history of a text's first token is its begin, which has a number of its own.
        history, history_count = np.empty_like(number), np.empty_like(count)
        history[1:], history_count[1:] = number[:-1], count[:-1]
        starts = ends - lengths + 1
        history[starts], history_count[starts] = words.numbers, words.documents
        plain = history_count == 0
        alone = np.where(plain, np.log10(words.probability(count)), 0.0)
        out = [(-1 - block, block, _pack(
            kind="texts", n_tokens=lengths, n_known=np.bincount(owner, weights=known, minlength=n_texts).astype(np.int64),
            base=np.bincount(owner, weights=base, minlength=n_texts), alone=np.bincount(owner, weights=alone, minlength=n_texts),
            doc_id=ids, held_out=~train,
        ))]
        use = ~plain
        h, w, hc, wc, d = history[use], number[use], history_count[use], count[use], owner[use]
        hot = hc > hot_tokens
        bucket = np.where(hot, mixed(w.astype(np.uint64)) % np.uint64(n_buckets), (mixed(h.astype(np.uint64)) >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((w, h, bucket))
        h, w, hc, wc, d, bucket = (x[order] for x in (h, w, hc, wc, d, bucket))
        new = np.ones(len(h), bool)
        new[1:] = (w[1:] != w[:-1]) | (h[1:] != h[:-1]) | (bucket[1:] != bucket[:-1])
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        small = np.uint32 if words.numbers < 2**32 - 2 else np.uint64
        for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
            if y == x:
                continue
            first = np.flatnonzero(new[x:y]) + x
            per_pair = np.diff(np.append(first, y))
            pair = np.repeat(np.arange(len(first)), per_pair)
            n_train = np.bincount(pair, weights=train[d[x:y]], minlength=len(first)).astype(np.uint32)
            out.append((b, block, _pack(
                step=_small(np.diff(h[first], prepend=0)), w=w[first].astype(small), hc=_small(hc[first]),
                wc=_small(wc[first]), n=_small(n_train), per_pair=_small(per_pair), owner=_small(d[x:y]),
            )))
        return pd.DataFrame(out, columns=["bucket", "block", "data"])

    return sent


def _groups(h: np.ndarray, w: np.ndarray, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each pair in the order of h and w, and the group of every row."""
    if numbers < 2**32 - 1:
        _, first, place = np.unique(h * np.uint64(numbers + 1) + w, return_index=True, return_inverse=True)
        return first, place
    order = np.lexsort((w, h))  # the product would not fit into 64 bits
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
    place = np.empty(len(h), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def _weights(history_count, seen_word_mass, by_count, discount) -> np.ndarray:
    """log10 a(h), from the count of the history, the sum of P(w) over the words seen after it, and the
    sums of c(h, w) over them by c(h, w) (last: above five).  A history whose bigrams are all above five
    has one more count, which makes room for the unseen."""
    kept = by_count[:, 1:-1] @ discount[1:] + by_count[:, -1]
    crowded = history_count - kept < 1e-9
    total = history_count + crowded
    return np.log10((1 - kept / total) / np.maximum(1 - seen_word_mass, 1e-300))


def _evaluated(words: Words, n_buckets: int):
    hot_tokens = max(1, words.tokens // (2 * n_buckets))

    def evaluated(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        if bucket < 0:
            return pd.DataFrame([("texts", int(rows["block"].iloc[0]), rows["data"].iloc[0])], columns=["kind", "block", "data"])
        parts = [_unpack(data) for data in rows["data"]]
        join = lambda name: np.concatenate([p[name].astype(np.int64) for p in parts])
        h = np.concatenate([np.cumsum(p["step"], dtype=np.uint64) for p in parts])
        w = join("w").astype(np.uint64)
        first, place = _groups(h, w, words.numbers)
        c = np.bincount(place, weights=join("n"), minlength=len(first)).astype(np.int64)
        h, hc, p = h[first].astype(np.int64), join("hc")[first], words.probability(join("wc")[first])
        # Sums over the bigrams of each history.
        starts = np.flatnonzero(np.diff(h, prepend=-1))
        of = np.cumsum(np.diff(h, prepend=-1) != 0) - 1
        mass = np.bincount(of, weights=np.where(c > 0, p, 0.0), minlength=len(starts))
        by_count = np.zeros((len(starts), LARGEST + 2))
        np.add.at(by_count, (of, np.minimum(c, LARGEST + 1)), c)
        history, history_count = h[starts], hc[starts]
        hot = history_count > hot_tokens
        out = [("hist", -1, _pack(hist=_hist(c)))]
        if hot.any():
            out.append(("hot", -1, _pack(h=history[hot], hc=history_count[hot], mass=mass[hot], by_count=by_count[hot])))
        cuts = np.cumsum([0] + [len(part["w"]) for part in parts])
        for block, part, x, y in zip(rows["block"], parts, cuts, cuts[1:]):
            pair = np.repeat(place[x:y], part["per_pair"])
            owner = part["owner"].astype(np.int64)
            seen = c[pair] > 0
            level = np.where(c[pair] <= LARGEST, c[pair], 0)
            own, local = np.unique(owner, return_inverse=True)
            size = len(own)
            log = np.zeros(len(pair))
            log[seen] = np.log10(c[pair][seen] / hc[pair][seen])
            by_level = np.zeros((size, LARGEST + 1), np.uint32)
            np.add.at(by_level, (local[seen], level[seen]), 1)
            # Histories with nothing to discount have one more count.
            crowded = seen & (by_count[of[pair], -1] >= hc[pair])
            some = crowded & ~hot[of[pair]]
            log[some] += np.log10(hc[pair][some] / (hc[pair][some] + 1))
            sums = np.bincount(local[seen], weights=log[seen], minlength=size)
            unseen = ~seen
            sums += np.bincount(local[unseen], weights=np.log10(p[pair][unseen]), minlength=size)
            at = of[pair]
            cold = unseen & ~hot[at]
            used, slot = np.unique(at[cold], return_inverse=True)
            out.append(("sums", int(block), _pack(
                own=_small(own), sums=sums, by_level=_small(by_level), owner=_small(owner[cold]), slot=_small(slot), hc=history_count[used], mass=mass[used], by_count=by_count[used],
            )))
            # Where this partition has a discounted bigram of the history, it is not crowded.
            warm = hot[at] & (unseen | (by_count[at, -1] >= by_count[at].sum(axis=1)))
            if warm.any():
                # Per history and document: unseen tokens, and seen ones that a crowded history rescales.
                pairs, where = np.unique(np.stack([history[at[warm]], owner[warm]]), axis=1, return_inverse=True)
                out.append(("warm", int(block), _pack(
                    h=pairs[0], owner=pairs[1], unseen=np.bincount(where.ravel(), weights=unseen[warm]),
                    seen=np.bincount(where.ravel(), weights=seen[warm]),
                )))
        return pd.DataFrame(out, columns=["kind", "block", "data"])

    return evaluated


def _exploded(schema: str, build):
    columns = [c.split()[0] for c in schema.split(", ")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, data in zip(frame["block"], frame["data"]):
                yield pd.DataFrame(dict(zip(columns, build(int(block), _unpack(data)))))

    return rows


def _final(discount: np.ndarray, words: Words):
    log_discount = np.log10(discount)

    def finished(rows: pd.DataFrame) -> pd.DataFrame:
        texts = _unpack(rows["data"][rows["kind"] == "texts"].iloc[0])
        score = texts["alone"].copy()
        for data in rows["data"][rows["kind"] == "sums"]:
            part = _unpack(data)
            own = part["own"].astype(np.int64)
            score[own] += part["sums"] + part["by_level"][:, 1:] @ log_discount[1:]
            if len(part["slot"]):
                weight = _weights(part["hc"], part["mass"], part["by_count"], discount)
                score += np.bincount(part["owner"], weights=weight[part["slot"]], minlength=len(score))
        warm = rows[rows["kind"] == "warm"]
        np.add.at(score, warm["owner"].to_numpy(np.int64), warm["added"].to_numpy(float))
        return pd.DataFrame({
            "doc_id": pd.array(texts["doc_id"], dtype="Int64"), "held_out": texts["held_out"], "n_tokens": texts["n_tokens"],
            "n_known": texts["n_known"], "train_tokens": words.tokens, "base_score": texts["base"], "score": score,
        })

    return finished


def katz_scores(documents: DataFrame, train: Column | None = None, block_bytes: int = 5 << 20, blocks_per_bucket: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are words and one end per text.  ``train`` says which rows the model learns from (default: the
    checksum of doc_id modulo 7 is not 2).  ``base_score`` is the add-one unigram score, log10((c + 1) / (N + V + 1)), ``score`` the
    model's log10 probability of the text; both go over n_tokens tokens.  Null and empty texts are one
    end.  A null doc_id counts as an empty text for the default rule.  Repeated rows are counted and scored
    each.  Without training rows every token is unknown and has a probability of one.  An empty table
    gives no rows; other columns are not read.
    """
    learn = train if train is not None else F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), learn.alias("train"))
    size = rows.agg(F.sum(F.octet_length("text") + 16).alias("b"), F.sum(F.col("train").cast("long")).alias("t")).first()
    n_blocks = max(1, -(-(size.b or 0) // block_bytes))
    n_buckets = max(1, n_blocks // blocks_per_bucket)
    block = F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(n_blocks))
    dealt = rows.withColumn("block", block).mapInArrow(_dealt, "block long, data binary")
    asked = dealt.groupBy("block").applyInPandas(_requests(n_blocks), _PACKED)
    table = stage(asked.groupBy("bucket").applyInPandas(_word_table, _PACKED))
    sums = {row.bucket: _unpack(bytes(row.data)) for row in table.where("block = -1").collect()}
    numbers = np.array([sums[b]["numbers"] if b in sums else 0 for b in range(n_blocks)], np.int64)
    mass = sum((s["mass"] for s in sums.values()), np.zeros(LARGEST + 2))
    words = Words(
        tokens=int(mass.sum()), distinct=sum(s["distinct"] for s in sums.values()), numbers=int(numbers.sum()),
        first=np.cumsum(numbers) - numbers, documents=int(size.t or 0),
        discount=discounts(sum((s["hist"] for s in sums.values()), np.zeros(LARGEST + 1, np.int64))),
    )
    if words.tokens:
        words.settle(float((mass[1:-1] @ words.discount[1:] + mass[-1]) / words.tokens))
    sent = dealt.groupBy("block").cogroup(table.where("block >= 0").groupBy("block")).applyInPandas(_bigrams(words, n_buckets), _PACKED)
    found = stage(sent.groupBy("bucket").applyInPandas(_evaluated(words, n_buckets), "kind string, block long, data binary"))
    counts = sum((_unpack(bytes(r.data))["hist"] for r in found.where("kind = 'hist'").collect()), np.zeros(LARGEST + 1, np.int64))
    discount = discounts(counts)
    by_level = [f"b{n}" for n in range(LARGEST + 2)]
    hot = found.where("kind = 'hot'").mapInPandas(
        _exploded("h long, hc long, mass double, by array<double>", lambda _, d: (d["h"], d["hc"], d["mass"], list(d["by_count"]))),
        "h long, hc long, mass double, by array<double>",
    )
    hot = hot.groupBy("h").agg(
        F.max("hc").alias("hc"), F.sum("mass").alias("mass"), *[F.sum(F.col("by")[n]).alias(c) for n, c in enumerate(by_level)]
    )
    kept = sum((F.col(f"b{n}") * float(discount[n]) for n in range(1, LARGEST + 1)), F.col(f"b{LARGEST + 1}"))
    crowded = F.col("hc") - kept < 1e-9
    total = F.col("hc") + crowded.cast("int")
    hot = hot.select(
        "h", F.log10((1 - kept / total) / F.greatest(1 - F.col("mass"), F.lit(1e-300))).alias("weight"),
        F.log10(F.col("hc") / total).alias("scale"),
    )
    warm = found.where("kind = 'warm'").mapInPandas(
        _exploded("block long, h long, owner long, unseen double, seen double",
                  lambda b, d: (np.full(len(d["h"]), b), d["h"], d["owner"], d["unseen"], d["seen"])),
        "block long, h long, owner long, unseen double, seen double",
    )
    added = (
        warm.join(hot, "h").groupBy("block", "owner")
        .agg(F.sum(F.col("unseen") * F.col("weight") + F.col("seen") * F.col("scale")).alias("added"))
    )
    gathered = found.where("kind IN ('texts', 'sums')").select(
        "kind", "block", "data", F.lit(None).cast("long").alias("owner"), F.lit(None).cast("double").alias("added")
    ).unionByName(added.select(F.lit("warm").alias("kind"), "block", F.lit(None).cast("binary").alias("data"), "owner", "added"))
    return gathered.groupBy("block").applyInPandas(
        _final(discount, words),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
