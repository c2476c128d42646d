"""Jaccard similarity join of documents' word-shingle sets by token-combination prefixes.

A token is the hash of a shingle.  Tokens have a global order: by how many documents hold them
(in four classes, see ``BORDERS``), then by hash.  If x and y are similar, y lacks
at most ``t`` tokens of x, a number that follows from the size of x alone; so of any
t + 1 tokens of x one is in y.  The prefix of x is its shortest beginning, in the
global order, that keeps more than t tokens after some are set aside:

* tokens of the rare classes count one each, and each is a signature;
* a frequent token shared by two documents says little, so tokens of the
  frequent classes are signatures only as combinations of k = 2 or 3 of them.  They are split
  by hash into subclasses of a few tokens, and k - 1 tokens of every subclass do
  not count: whichever t tokens y lacks, some rare token or some whole combination of
  one subclass remains.  The prefix is extended for that, and all combinations within its
  subclasses are indexed.  How many subclasses there are depends on the set's size
  band (powers of two); a set is indexed in each band that a similar set may be in.

Of two similar sets the one whose prefix ends first has such a signature, and the other's
prefix holds it too.  Every signature that two different sets share makes them
candidates, whose whole sets are then compared.  Tokens that one set alone holds come
first and are not indexed, so most sets have no signature at all.

Candidates of a signature are not expanded into all pairs.  Links only have to
decide what is connected: first each member is compared with one member that
comes first in its groups; of groups that are not yet connected the members are compared with the group's first one.
What is then still in different components is compared as pairs in groups of up to ``SMALL``
members.  Larger groups that share members form a family (near copies just around the border):
its members are dealt into blocks by size, and those outside its largest component visit the blocks
that hold sizes similar to theirs, where one pass over a block's inverted lists counts all common tokens
of a visitor; only links come out.  Equal sets are one set throughout.
Each step is a shuffle by signature, set, component or block; groups are cut into
pieces, and only three tables of a fixed size reach the driver: bit tables of token classes, of the sets
wanted and of the rows that stand for their text (``SLOTS``), which may hold a token in too frequent a class, or a set
or row too many, but never too few, so results do not depend on them.

Rows of the same text (by MD5) are one text before anything else: the row of the smallest doc_id stands for it, and only such
rows are cut into tokens, counted and signed.  Else copies in different tasks would pass for documents that
share all their tokens, and every set would have signatures.

A null, empty or word-free text has no tokens and links with nothing.  Fewer words than a shingle's are one
shingle.  A null doc_id is never the smallest unless all are null; repeated rows share
their component; an empty table gives no rows; extra columns are not looked at.
Tokens are 64-bit hashes and sets are known by 128 bits: unlike shingles or sets
of equal hashes would be taken for the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import U64, WordHash, components, grams, kept_rows, map_arrow, mix, written

# A token is of class 0, 1, 2 or 3 if more than none, the first, the second or the third of these numbers of documents hold it.
BORDERS = (1, 16, 512)
# Tokens of a combination, by class; tokens of classes 0 and 1 stand alone.
TOGETHER = (1, 1, 2, 3)
# Tokens of a subclass, on average over a whole set of that class, by class.
SUBCLASS = (0, 0, 4, 8)
# Bits of the hash that choose a slot of the bit table of classes 1, 2 and 3, of wanted sets and of rows that stand for a text (memory bounds only).
SLOTS = (26, 24, 22)
SET_SLOTS = 24
ROW_SLOTS = 26
# Tokens or signatures that a task sorts at a time, and members of a piece of a group (memory bounds only).
FLUSH = 1 << 22
PIECE = 1024
# Members of a group up to which its pairs are compared one by one, and of a block of a family (the plan only).
SMALL = 32
BLOCK = 1024


def token_set(text: bytes | None, words: WordHash, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles, of all words where they are fewer."""
    found = text.lower().split() if text else []
    return np.unique(grams(words.array(found), min(k, len(found)))) if found else np.empty(0, dtype=U64)


def key_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def ref_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def marked(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """1 for hashes whose slot in a bit table is set, else 0."""
    bits = (8 * len(packed)).bit_length() - 1
    slot = (hashes >> U64(64 - bits)).astype(np.int64)
    return packed[slot >> 3] >> (slot & 7).astype(np.uint8) & 1


def bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit table for ``marked`` of a column of 64-bit hashes."""
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    # shuffled as numbers, each once a task; then at most 2 ** (bits - 15) rows of 4 KB
    parts = hashes.select(F.shiftright(slot, 15).alias("part"), (slot % 32768).alias("bit")).distinct().repartition("part")
    packed = np.zeros(max(4096, 1 << bits >> 3), dtype=np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        packed[row.part * 4096 : (row.part + 1) * 4096] = np.frombuffer(row.bits, dtype=np.uint8)
    return packed[: 1 << bits >> 3]


def sets(batches: Iterator[pa.RecordBatch], k: int, stands: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    """Text hash and tokens of the rows ``(place, text_hash, text)`` that stand for their text."""
    words = WordHash()
    for batch in batches:
        place = np.asarray(batch.column(0)).view(U64)
        batch = batch.filter(pa.array(marked(stands, place) > 0))
        for text_hash, text in zip(batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            yield text_hash, token_set(text.as_py(), words, k)


def lacking(n: int, percent: int) -> int:
    """Most tokens of a set of ``n`` that a similar set can lack."""
    return n - -(-percent * n // 100)


# --- texts -----------------------------------------------------------------------

TEXT = np.dtype([("text_hash", "V16"), ("n", "<i8"), ("key", "V16")])


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, text_hash``; an empty text has no hash, as a null one."""
    text = F.when(F.col("text") != "", F.col("text"))
    return docs.select("doc_id", "text", F.unhex(F.md5(text)).alias("text_hash"))


def place_of(doc_id: str) -> F.Column:
    return F.xxhash64(doc_id, "text_hash")


def known_texts(counted: DataFrame) -> DataFrame:
    """``(text_hash, n_shingles, key)`` of every text that has tokens, from what ``token_classes`` wrote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rows = np.frombuffer(blob, dtype=TEXT)
                yield {"text_hash": [x.tobytes() for x in rows["text_hash"]], "n_shingles": rows["n"].tolist(), "key": [x.tobytes() for x in rows["key"]]}

    return map_arrow(counted.where("texts is not null").select("texts"), run, "text_hash binary, n_shingles bigint, key binary")


# --- token classes ---------------------------------------------------------------


def bucket_bits(df: DataFrame) -> int:
    """Leading bits of a hash that choose its bucket: a few buckets for each shuffle partition, 1,024 at least."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(10, (4 * n - 1).bit_length()), min(SLOTS))


def merged(rows: DataFrame, merge: Callable, schema: str) -> DataFrame:
    """``merge(bucket, other columns of all its rows)`` for each ``bucket``, the first column of ``rows``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != at:
                    yield from merge(at, list(zip(*held))[1:])
                    held = []
                at = row[0]
                held.append(row)
        if held:
            yield from merge(at, list(zip(*held))[1:])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(rows.repartition(n, "bucket").sortWithinPartitions("bucket"), gather, schema)


def by_bucket(values: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Runs of sorted 64-bit ``values`` with the same leading ``bits``."""
    head = (values >> U64(64 - bits)).astype(np.int64)
    cuts = np.r_[0, np.flatnonzero(head[1:] != head[:-1]) + 1, len(head)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield int(head[a]), slice(a, b)


def following(values: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the leading ``bits``."""
    return (values >> U64(32 - bits)).astype(np.uint32)


class Classes:
    """The class of a token, from three bit tables."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables

    def above(self, border: int, tokens: np.ndarray) -> np.ndarray:
        """1 for tokens above a border, else 0."""
        return marked(self.tables[border], tokens)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(tokens), dtype=np.int64)
        for border in range(len(self.tables)):
            out += self.above(border, tokens)
        return out


def token_classes(docs: DataFrame, stands: np.ndarray, k: int) -> tuple[Classes, DataFrame]:
    """Counts the texts of every token (equal sets of a task once) and keeps who is above the borders; also a table for ``known_texts``."""
    bits = bucket_bits(docs)
    borders, slots_of, flush_at = BORDERS, SLOTS, FLUSH
    most = borders[-1] + 1  # larger counts are as good as this one
    shared = docs.sparkSession.sparkContext.broadcast(stands)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen, held, texts, size = set(), [], [], 0

        def flush() -> dict:
            tokens, n = np.unique(np.concatenate(held or [np.empty(0, dtype=U64)]), return_counts=True)
            n = np.minimum(n, most).astype(np.uint16)
            out: dict[str, list] = {"bucket": [], "tokens": [], "n": [], "texts": []}
            for bucket, part in by_bucket(tokens, bits):
                for name, value in zip(out, (bucket, following(tokens[part], bits).tobytes(), n[part].tobytes(), b"")):
                    out[name].append(value)
            head = np.frombuffer(b"".join(texts), dtype=TEXT)["text_hash"].copy().view(">u8")[::2].astype(U64)
            order = np.argsort(head)
            for bucket, part in by_bucket(head[order], bits):
                for name, value in zip(out, (bucket, b"", b"", b"".join(texts[i] for i in order[part].tolist()))):
                    out[name].append(value)
            return out

        for text_hash, tokens in sets(batches, k, shared.value):
            if not len(tokens):
                continue
            key = key_of(tokens)
            texts.append(np.array((text_hash, len(tokens), key), dtype=TEXT).tobytes())
            if key not in seen:
                seen.add(key)
                held.append(tokens)
                size += len(tokens)
            if size >= flush_at or len(texts) >= flush_at:
                yield flush()
                held, texts, size = [], [], 0
        if texts:
            yield flush()

    def merge(bucket: int, cols: list) -> Iterator[dict]:
        tokens = np.frombuffer(b"".join(cols[0]), dtype=np.uint32)
        n = np.frombuffer(b"".join(cols[1]), dtype=np.uint16)
        order = np.argsort(tokens, kind="stable")
        tokens, n = tokens[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]][: len(tokens)])
        total, tokens = np.add.reduceat(n, first) if len(n) else n, tokens[first]
        texts = np.frombuffer(b"".join(cols[2]), dtype=f"V{TEXT.itemsize}")
        out = {"bucket": [bucket], "texts": [b"".join(sorted(set(texts.tolist()))) or None]}
        for i, (slots, border) in enumerate(zip(slots_of, borders)):
            # the slot's bits after the bucket's
            flags = np.zeros(1 << (slots - bits), dtype=bool)
            flags[tokens[total > border] >> np.uint32(32 - (slots - bits))] = True
            out[f"c{i}"] = [np.packbits(flags, bitorder="little").tobytes() if flags.any() else None]
        yield out

    counted = map_arrow(docs, count, "bucket int, tokens binary, n binary, texts binary")
    counted = written(merged(counted, merge, "bucket int, c0 binary, c1 binary, c2 binary, texts binary"), "jaccard-counted")
    # at most one row a bucket, together the bit tables of SLOTS
    rows = counted.drop("texts").collect()
    tables = [np.zeros(1 << (slots - 3), dtype=np.uint8) for slots in SLOTS]
    for row in rows:
        for i, slots in enumerate(SLOTS):
            if row[f"c{i}"] is not None:
                width = max(1, 1 << (slots - bits) >> 3)
                if slots - bits >= 3:
                    tables[i][row.bucket * width : (row.bucket + 1) * width] = np.frombuffer(row[f"c{i}"], dtype=np.uint8)
                else:  # several buckets share a byte
                    here = row.bucket << (slots - bits)
                    tables[i][here >> 3] |= row[f"c{i}"][0] << (here & 7)
    return Classes(tables), counted


# --- signatures ----------------------------------------------------------------------


def bands(n: int, percent: int) -> range:
    """Size bands (powers of two) in which a set similar to one of ``n`` tokens may be."""
    return range((-(-percent * n // 100)).bit_length() - 1, (100 * n // percent).bit_length())


def occurrence(group: np.ndarray) -> np.ndarray:
    """How often each value occurred before."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    at = np.arange(len(group))
    out = np.empty(len(group), dtype=np.int64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def combinations(tokens: np.ndarray, group: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hashes of all ``size`` (2 or 3) tokens of one group."""
    order = np.lexsort((tokens, group))
    tokens, before = tokens[order], occurrence(group[order])
    out = []
    seeded = mix(tokens + U64(salt))
    with np.errstate(over="ignore"):
        for d in range(1, int(before.max(initial=0)) + 1):
            i = np.flatnonzero(before >= d)
            two = mix(seeded[i - d] * U64(3) + tokens[i])
            if size == 2:
                out.append(two)
            else:
                for e in range(d + 1, int(before.max()) + 1):
                    j = before[i] >= e
                    out.append(mix(seeded[i[j] - e] * U64(5) + two[j]))
    return np.concatenate(out) if out else np.empty(0, dtype=U64)


def signatures(tokens: np.ndarray, classes: Classes, percent: int) -> np.ndarray:
    """Signatures of a set, without those that no other set can have."""
    n = len(tokens)
    need = lacking(n, percent) + 1
    # sets of so few tokens are similar to equal ones only; with so many tokens of its own a prefix has no partners
    if percent * (n + 1) > 100 * n or n - int(classes.above(0, tokens).sum()) >= need:
        return np.empty(0, dtype=U64)
    cls = classes.of(tokens)
    order = np.argsort(cls, kind="stable")  # tokens are sorted by hash
    tokens, cls = tokens[order], cls[order]
    out = []
    for band in bands(n, percent):
        group = np.arange(n)
        for c in (2, 3):
            mine = cls == c
            subs = max(1, (1 << band) // SUBCLASS[c])
            group[mine] = n + c * n + (mix(tokens[mine] + U64(c)) % U64(subs)).astype(np.int64)
        counts = occurrence(group) >= np.array(TOGETHER)[cls] - 1
        end = int(np.searchsorted(np.cumsum(counts), need)) + 1
        head, kind = tokens[:end], cls[:end]
        out.append(head[kind == 1])
        for c in (2, 3):
            mine = kind == c
            if mine.any():
                out.append(combinations(head[mine], group[:end][mine], TOGETHER[c], band * 8 + c))
    return np.unique(np.concatenate(out))


def signed(docs: DataFrame, stands: np.ndarray, classes: Classes, k: int, percent: int) -> DataFrame:
    """Rows ``(bucket, sigs, refs)`` of signatures and sets."""
    bits, flush_at = bucket_bits(docs), FLUSH
    shared = docs.sparkSession.sparkContext.broadcast((stands, classes.tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen, sigs, refs, size = set(), [], [], 0
        known = Classes(shared.value[1])

        def flush() -> dict:
            s, r = np.concatenate(sigs), np.concatenate(refs)
            order = np.argsort(s, kind="stable")
            s, r = s[order], r[order]
            out: dict[str, list] = {"bucket": [], "sigs": [], "refs": []}
            for bucket, part in by_bucket(s, bits):
                out["bucket"].append(bucket)
                out["sigs"].append(following(s[part], bits).tobytes())
                out["refs"].append(r[part].tobytes())
            return out

        for _, tokens in sets(batches, k, shared.value[0]):
            key = key_of(tokens)
            if not len(tokens) or key in seen:
                continue
            seen.add(key)
            mine = signatures(tokens, known, percent)
            if len(mine):
                sigs.append(mine)
                refs.append(np.full(len(mine), ref_of(key), dtype=np.int64))
                size += len(mine)
                if size >= flush_at:
                    yield flush()
                    sigs, refs, size = [], [], 0
        if sigs:
            yield flush()

    return map_arrow(docs, run, "bucket int, sigs binary, refs binary")


def candidate_groups(rows: DataFrame) -> DataFrame:
    """Groups ``(gid, refs)`` of two sets or more that share a signature, from the rows of ``signed``.

    Groups with equal members are one.  A group of more than ``PIECE`` members is several rows of
    one gid, each beginning with the group's first member.
    """
    piece = PIECE

    def merge(bucket: int, cols: list) -> Iterator[dict]:
        sigs = np.frombuffer(b"".join(cols[0]), dtype=np.uint32)
        refs = np.frombuffer(b"".join(cols[1]), dtype=np.int64)
        order = np.lexsort((refs, sigs))
        sigs, refs = sigs[order], refs[order]
        new = np.r_[True, (sigs[1:] != sigs[:-1]) | (refs[1:] != refs[:-1])]
        sigs, refs = sigs[new], refs[new]
        cuts = np.r_[0, np.flatnonzero(sigs[1:] != sigs[:-1]) + 1, len(sigs)]
        small, out = set(), {"large": [], "refs": []}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if 2 <= b - a <= piece:
                small.add(refs[a:b].tobytes())
            elif b - a > piece:
                for at in range(a + 1, b, piece - 1):
                    out["large"].append(bucket << 32 | int(sigs[a]))
                    out["refs"].append(np.r_[refs[a], refs[at : min(b, at + piece - 1)]])
        for group in small:
            out["large"].append(None)
            out["refs"].append(np.frombuffer(group, dtype=np.int64))
        yield out

    groups = merged(rows, merge, "large bigint, refs array<bigint>").distinct()
    # ids of small groups are below zero, those of large ones are their signatures
    gid = F.coalesce("large", -1 - F.monotonically_increasing_id())
    return written(groups.select(gid.alias("gid"), "refs"), "jaccard-groups")


# --- verification ----------------------------------------------------------------------


def whole_sets(docs: DataFrame, stands: np.ndarray, refs: DataFrame, classes: Classes, k: int) -> DataFrame:
    """Sets ``(ref, key, n, tokens)`` of those in ``refs (ref)`` at least, each once; tokens held by one set alone only count in ``n``."""
    flush_at = FLUSH // 4
    shared = docs.sparkSession.sparkContext.broadcast((stands, bit_table(refs, SET_SLOTS), classes.tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        wanted, known, seen = shared.value[1], Classes(shared.value[2]), set()
        out: dict[str, list] = {"ref": [], "key": [], "n": [], "tokens": []}
        size = 0
        for _, tokens in sets(batches, k, shared.value[0]):
            key = key_of(tokens)
            ref = ref_of(key)
            if len(tokens) and key not in seen and marked(wanted, np.array([ref]).view(U64))[0]:
                seen.add(key)
                common = tokens[known.above(0, tokens) > 0]
                for name, value in zip(out, (ref, key, len(tokens), common.tobytes())):
                    out[name].append(value)
                size += len(common)
                if size >= flush_at:
                    yield out
                    out, size = {name: [] for name in out}, 0
        yield out

    found = map_arrow(docs, run, "ref bigint, key binary, n bigint, tokens binary")
    return written(found.dropDuplicates(["ref", "key"]), "jaccard-sets")


def needed(whole: DataFrame, refs: DataFrame) -> DataFrame:
    """The sets of ``whole`` in ``refs (ref)`` at least, so that a join shuffles no others."""
    shared = whole.sparkSession.sparkContext.broadcast(bit_table(refs, SET_SLOTS))

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bool]]:
        for batch in batches:
            yield (marked(shared.value, np.asarray(batch.column(0)).view(U64)) > 0).tolist()

    return kept_rows(whole, masks)


LINK = "ra bigint, rb bigint, a binary, b binary"


def is_similar(n: int, m, common, percent: int):
    """Whether sets of ``n`` and ``m`` tokens with so many in common are similar (also for arrays)."""
    return 100 * common >= percent * (n + m - common)


def similar(whole: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Links (refs ``ra``, ``rb`` and set keys ``a``, ``b``): those of ``pairs (a, b)`` of refs whose sets are similar."""
    side = lambda x: needed(whole, pairs.select(x)).select(F.col("ref").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("key", "n", "tokens")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ra, ka, na, ta, rb, kb, nb, tb = (batch.column(i).to_pylist() for i in range(8))
            keep = []
            for i, (n, x, m, y) in enumerate(zip(na, ta, nb, tb)):
                if is_similar(n, m, min(n, m), percent):
                    x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
                    if is_similar(n, m, len(np.intersect1d(x, y, assume_unique=True)), percent):
                        keep.append(i)
            yield {name: [c[i] for i in keep] for name, c in zip(("ra", "rb", "a", "b"), (ra, rb, ka, kb))}

    cols = [f"{c}_{x}" if c else x for x in "ab" for c in ("", "key", "n", "tokens")]
    return map_arrow(pairs.join(side("b"), "b").join(side("a"), "a").select(*cols), run, LINK)


MEMBER = "ref bigint, root bigint, key binary, n bigint, tokens binary"


class Block:
    """Members of a family with the inverted lists of their tokens."""

    def __init__(self, members: list[tuple]):
        self.refs, self.roots, self.keys, n, tokens = zip(*members)
        self.n, self.root_of = np.array(n, dtype=np.int64), np.array(self.roots, dtype=np.int64)
        tokens = [np.frombuffer(t, dtype=U64) for t in tokens]
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        every = np.concatenate(tokens)
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.tokens, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)

    def links(self, root: int, n: int, tokens: np.ndarray, percent: int) -> list[int]:
        """A similar member of each component but the visitor's own."""
        tokens = tokens[tokens <= self.tokens[-1]] if len(self.tokens) else tokens[:0]
        at = np.searchsorted(self.tokens, tokens)
        at = at[self.tokens[at] == tokens]
        count = self.count[at]
        lists = np.repeat(self.first[at] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(int(count.sum()))
        common = np.bincount(self.owner[lists], minlength=len(self.n))
        found = np.flatnonzero(is_similar(n, self.n, common, percent) & (self.root_of != root))
        return found[np.unique(self.root_of[found], return_index=True)[1]].tolist()


def family_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between members ``(family, main, ref, root, key, n, tokens)`` of one family and different ``root``.

    Members outside the family's ``main`` component visit the blocks of similar sizes.
    """
    size = BLOCK
    spark = members.sparkSession
    cols = ["ref", "root", "key", "n", "tokens"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple] = []

        def block() -> dict:
            ns = [m["n"] for _, m in held]
            return {"family": [held[0][0]], "low": [min(ns)], "high": [max(ns)], "members": [[m for _, m in held]]}

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == size or held[0][0] != row["family"]):
                    yield block()
                    held = []
                held.append((row["family"], {c: row[c] for c in cols}))
        if held:
            yield block()

    dealt = members.select("family", *cols).repartitionByRange("family", "n", "ref").sortWithinPartitions("family", "n", "ref")
    packed = map_arrow(dealt, pack, f"family bigint, low bigint, high bigint, members array<struct<{MEMBER.replace(' ', ':').replace(',:', ', ')}>>")
    blocks = written(packed.select(F.monotonically_increasing_id().alias("bid"), "*"), "jaccard-blocks")
    home = blocks.select("bid", "family", "low", "high")
    visitor = members.where("root <> main").join(home, "family")
    visitor = visitor.where((F.col("low") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col("high") * 100))
    kind = blocks.schema["members"].dataType
    hosts = blocks.select("bid", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in MEMBER.split(", "))), "members")
    guests = visitor.select("bid", F.lit(1).alias("kind"), *cols, F.lit(None).cast(kind).alias("members"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block = None
        for batch in batches:
            out: dict[str, list] = {"ra": [], "rb": [], "a": [], "b": []}
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    block = Block([tuple(m[c] for c in cols) for m in row["members"]])
                    continue
                for i in block.links(row["root"], row["n"], np.frombuffer(row["tokens"], dtype=U64), percent):
                    for name, value in zip(out, (row["ref"], block.refs[i], row["key"], block.keys[i])):
                        out[name].append(value)
            yield out

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = hosts.unionByName(guests).repartition(n, "bid").sortWithinPartitions("bid", "kind", "ref")
    return map_arrow(stream, visit, LINK)


def linked(groups: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Components ``(node, root)`` of set keys under links between members of the same group."""
    first = F.element_at("refs", 1)
    star = groups.select(first.alias("a"), F.explode(F.expr("slice(refs, 2, size(refs) - 1)")).alias("b"))
    # 1. each member with the smallest of its groups' first members
    pairs = written(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "jaccard-pairs")
    links = written(similar(whole, pairs, percent), "jaccard-links")

    def components_of(links: DataFrame) -> DataFrame:
        """Components of refs."""
        return written(components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")), "jaccard-cc"), "jaccard-comp")

    # 2. members with each group's first one, where that is in another component
    comp = components_of(links)
    root = lambda side: comp.select(F.col("node").alias(side), F.col("root").alias(f"r_{side}"))
    apart = star.distinct().join(root("a"), "a", "left").join(root("b"), "b", "left")
    apart = apart.where(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b").join(pairs, ["a", "b"], "left_anti")
    apart = written(apart, "jaccard-pairs")
    links = links.union(written(similar(whole, apart, percent), "jaccard-links"))
    # 3. members in different components, of groups that are not one component yet
    comp = components_of(links)
    member = groups.select("gid", F.explode("refs").alias("ref")).distinct()
    member = member.join(comp.withColumnRenamed("node", "ref"), "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    split = member.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m"))
    split = written(split.where("low <> high").select("gid", "m"), "jaccard-split")
    near = written(member.join(split.where(F.col("m") <= SMALL), "gid", "left_semi"), "jaccard-members")
    other = near.select("gid", F.col("ref").alias("b"), F.col("root").alias("r_b"))
    rest = near.withColumnRenamed("ref", "a").join(other, "gid").where("a < b and root <> r_b").select("a", "b").distinct()
    rest = written(rest.join(pairs.union(apart), ["a", "b"], "left_anti"), "jaccard-pairs")
    links = links.union(written(similar(whole, rest, percent), "jaccard-links"))
    # large groups with members in common are a family
    large = groups.join(split.where(F.col("m") > SMALL), "gid", "left_semi")
    family = large.select(first.alias("a"), F.explode(F.expr("slice(refs, 2, size(refs) - 1)")).alias("b")).distinct()
    family = written(components(family, "jaccard-cc"), "jaccard-families").select(F.col("node").alias("ref"), F.col("root").alias("family"))
    family = family.join(comp.withColumnRenamed("node", "ref"), "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    count = family.groupBy("family", "root").agg(F.count("*").alias("m"))
    main = count.groupBy("family").agg(F.max(F.struct("m", "root")).alias("x")).select("family", F.col("x.root").alias("main"))
    member = written(family.join(main, "family"), "jaccard-members")
    links = links.union(written(family_links(member.join(needed(whole, member.select("ref")), "ref"), percent), "jaccard-links"))
    return components(links.select("a", "b"), "jaccard-cc")


def similarity_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs (doc_id, text)``.

    Two documents link when their sets of ``k``-word shingles share at least ``percent`` of
    their union; ``component_id`` is the smallest doc_id reachable by links, itself included.
    """
    if not 80 <= percent <= 100:  # below, subclasses could set too many tokens of a small set aside
        raise ValueError("percent must be from 80 to 100")

    docs = hashed(docs)
    rows = written(docs.select("doc_id", "text_hash"), "jaccard-rows")
    bare, rows = rows.where("text_hash is null"), rows.where("text_hash is not null")
    texts = written(rows.groupBy("text_hash").agg(F.min("doc_id").alias("first_id")), "jaccard-texts")
    stands = bit_table(texts.select(place_of("first_id")), ROW_SLOTS)
    docs = docs.where("text_hash is not null").select(place_of("doc_id"), "text_hash", "text")
    classes, counted = token_classes(docs, stands, k)
    groups = candidate_groups(signed(docs, stands, classes, k, percent))
    whole = whole_sets(docs, stands, groups.select(F.explode("refs").alias("ref")).distinct(), classes, k)
    comp = linked(groups, whole, percent).withColumnRenamed("node", "key")
    known = known_texts(counted)
    first = written(known.join(texts, "text_hash").groupBy("key").agg(F.min("first_id").alias("first_id")), "jaccard-first")
    rooted = first.join(comp, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = known.join(rooted.join(lowest, "root").select("key", "component_id"), "key")
    each = rows.join(ids, "text_hash", "left")
    alone = F.col("n_shingles").isNull()
    each = each.select("doc_id", F.coalesce("n_shingles", F.lit(0).cast("bigint")).alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return each.union(bare.select("doc_id", F.lit(0).cast("bigint"), "doc_id"))
