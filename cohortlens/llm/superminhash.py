"""Near-duplicate groups: SuperMinHash signatures, banding, verification, grouping.

* A document's set is its distinct shingles of ``shingle`` words, four by default (the whole word sequence if it has fewer words).
  Shingles are 64-bit hashes; equal sets form a class, and one member of a class stands for it.
* SuperMinHash: every element visits the slots in an order of its own (a permutation), the j-th visit
  with value j + a uniform number; a slot keeps the least value's element. The ranks of one element are
  correlated over the slots, which lowers the variance, and a set stops once all slots are filled, for a
  later visit cannot win. (The order is a random affine permutation modulo the prime ``SLOTS``.)
* Banding: ``BANDS`` bands of ``ROWS`` slots. A pair at similarity 0.8 shares no band with probability
  (1 - 0.8^4)^24 = 3e-6.
* Links are confirmed on full sets: first of every member of a bucket with the bucket's least member, then,
  within buckets whose members are in more than one group yet, of all other pairs between groups whose
  sizes and signatures allow the similarity, in bounded blocks that give links alone: first over signatures, which tell the rows that
  take part in such a pair; only their texts are moved. Pairs within a group need no check.
  No bucket is capped, and no pair of different groups that shares a bucket stays unchecked. The signature
  test (at least ``LEAST_EQUAL`` of 97 slots) is 5 standard deviations below what a linked pair has.
* Groups are connected components by alternating large-star and small-star rounds, a distributed union-find.

Defined results: a null text or one without words has an empty set, is linked with nothing and is its own
group; rows with the same id are one document (its links are those of any of its texts); rows with a
null id are left alone (component null, kept); repeated rows and ties fall to the least id; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.util import blocks
from cohortlens.operators.components import connected_components
from cohortlens.session import materialize

SHINGLE, PERCENT = 4, 80
SLOTS, BANDS, ROWS = 97, 24, 4
LEAST_EQUAL = 57
BLOCK_BYTES = 1 << 18  # text handled at once in a task; NumPy takes about 80 bytes a byte of it
BROADCAST_IDS = 1 << 21  # ids (8 bytes each) that may be broadcast to pick texts by
GROUP_ROWS = 256  # members of one leader, or of one side of a block of pairs, in a group
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_WHITE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64. Kept up to twice the usual block; more only for a huge word."""
    if len(_powers[0]) >= n:
        return _powers
    new = []
    for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        a = np.full(n, b, dtype=_U)
        a[0] = 1
        new.append(np.cumprod(a))
    if n <= 2 * BLOCK_BYTES:
        _powers[:] = new
    return new


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word, A-Z as a-z. A long text is handled in pieces, cut at white space."""
    parts, at = [], 0
    while True:
        cut = _WHITE.search(text, at + BLOCK_BYTES) if len(text) - at > BLOCK_BYTES else None
        end = cut.start() if cut else len(text)
        hashes, first = _word_hashes(text[at:end])
        parts.append((hashes, first + at))
        at = end
        if at >= len(text):
            return np.concatenate([h for h, _ in parts]), np.concatenate([f for _, f in parts])


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A polynomial over each word's bytes from one running sum over the text."""
    a = np.frombuffer(text.lower(), dtype=np.uint8)
    edge = np.diff(np.concatenate(([0], (~_SPACE[a]).astype(np.int8), [0])))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power(len(a) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum((a.astype(_U) + _U(1)) * up[:len(a)])))
    return mix((total[end] - total[first]) * down[first] + (end - first).astype(_U)), first


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = word_hashes(b"\n".join(texts))
    edges = np.searchsorted(first, np.cumsum([0] + [len(t) + 1 for t in texts]))
    n = max(0, len(hashes) - shingle + 1)
    s = hashes[:n]
    for k in range(1, shingle):
        s = mix(s * _BASE + hashes[k:n + k])
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a >= shingle:
            out.append(np.unique(s[a:b - shingle + 1]))
        else:
            whole = np.full(min(1, b - a), b - a, dtype=_U)
            for h in hashes[a:b]:
                whole = mix(whole * _BASE + h)
            out.append(whole)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, SLOTS) of 16 bits of each slot's element. All sets advance together, rank by rank; full ones stop."""
    size = np.array([len(s) for s in sets])
    best = np.full((len(sets), SLOTS), np.iinfo(np.uint64).max, dtype=_U)
    flat = best.ravel()
    e = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    doc = np.repeat(np.arange(len(sets)), size)
    place, step = (e >> _U(7)) % _U(SLOTS), _U(1) + (e >> _U(33)) % _U(SLOTS - 1)
    tag = mix(e + _U(77)) & _U(0xFFFF)
    for j in range(SLOTS):
        draw = mix(e + np.array([j + 1], _U) * _BASE) >> _U(32)
        np.minimum.at(flat, doc * SLOTS + place.astype(np.int64), (_U(j) << _U(48)) | (draw << _U(16)) | tag)
        place = (place + step) % _U(SLOTS)
        todo = (best.max(axis=1) == np.iinfo(np.uint64).max)[doc]
        if not todo.any():
            break
        if not todo.all():
            e, doc, place, step, tag = e[todo], doc[todo], place[todo], step[todo], tag[todo]
    return (best & _U(0xFFFF)).astype("<u2")


def _describe(batches: Iterator[pd.DataFrame], shingle: int = SHINGLE) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = batch["id"]
        for i, texts in blocks(batch["text"], BLOCK_BYTES):
            sets = shingle_sets(texts, shingle)
            sig = signatures(sets)
            with np.errstate(over="ignore"):
                h = [[int(mix(s + _U(k)).sum(dtype=_U).astype(np.int64)) for s in sets] for k in (1, 2)]
            yield pd.DataFrame({"id": ids.iloc[i:i + len(texts)], "n": [len(s) for s in sets], "h1": h[0], "h2": h[1],
                                "sig": [r.tobytes() for r in sig]})


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same > 0 and 100 * same >= PERCENT * (len(a) + len(b) - same)


def _confirm(batches: Iterator[pd.DataFrame], shingle: int = SHINGLE) -> Iterator[pd.DataFrame]:
    """Sorted rows (leader, salt, member, is_member, text), a leader before its members: the linked pairs."""
    leader, own, in_members = None, [], False
    for batch in batches:
        a, b = [], []
        for i, texts in blocks(batch["text"], BLOCK_BYTES):
            rows = batch.iloc[i:i + len(texts)]
            for lead, member, is_member, s in zip(rows["leader"], rows["member"], rows["is_member"], shingle_sets(texts, shingle), strict=True):
                if not is_member:
                    own = [*own, s] if lead == leader and not in_members else [s]  # an id may have several texts
                    leader = lead
                elif lead == leader and any(_linked(o, s) for o in own):
                    a.append(lead)
                    b.append(member)
                in_members = is_member
        yield pd.DataFrame({"a": a, "b": b}, dtype="int64")


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (leader, member) that are linked, on the full sets of ``texts`` (id, text), one row per text.

    A leader's members are dealt to groups of about GROUP_ROWS, each with a copy of the leader; a task streams
    its groups and holds one leader's set at a time."""
    salts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("salts"))
    leaders = salts.join(texts, salts["leader"] == texts["id"]).select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("leader").alias("member"), F.lit(False).alias("is_member"), "text")
    members = pairs.join(salts, "leader").join(texts, F.col("member") == texts["id"]).select(
        "leader", F.pmod(F.hash("member"), F.col("salts")).alias("salt"), "member", F.lit(True).alias("is_member"), "text")
    rows = leaders.unionByName(members).repartition("leader", "salt").sortWithinPartitions("leader", "salt", "is_member")
    return rows.mapInPandas(partial(_confirm, shingle=shingle), "a long, b long")


def _likely(x, y, band, block, comp, n, sig) -> list[tuple[int, int, int]]:
    """(- equal slots, i, j) of the pairs between groups in one block of pairs that sizes and signatures allow. A pair
    belongs to the first band that it shares."""
    lanes = np.ascontiguousarray(sig[:, :BANDS * ROWS]).view("<u8")
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    out = []
    for k, i in enumerate(left):
        other = right[k + 1:] if x == y else right
        other = other[(comp[other] != comp[i]) & (100 * np.minimum(n[other], n[i]) >= PERCENT * np.maximum(n[other], n[i]))]
        equal, same = (sig[other] == sig[i]).sum(axis=1), lanes[other] == lanes[i]
        ok = (equal >= LEAST_EQUAL) & (same.argmax(axis=1) == band) & same.any(axis=1)
        out += [(-e, i, j) for e, j in zip(equal[ok], other[ok], strict=True)]
    return out


def _blocks_of_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by (key, x, y), with two rows at least."""
    rest = None
    for batch in batches:
        rest = pd.concat([rest, batch], ignore_index=True) if rest is not None else batch
        where = rest[["key", "x", "y"]].to_numpy()
        cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                yield rest.iloc[a:b]
        rest = rest.iloc[cuts[-1]:].reset_index(drop=True)  # its group may go on in the next batch
    if rest is not None and len(rest) > 1:
        yield rest


def _pairs_of(rows: pd.DataFrame) -> list[tuple[int, int, int]]:
    sig = np.frombuffer(b"".join(rows["sig"]), "<u2").reshape(len(rows), SLOTS)
    x, y, band = (rows[c].iloc[0] for c in ("x", "y", "band"))
    return _likely(x, y, band, *[rows[c].to_numpy() for c in ("block", "comp", "n")], sig)


def _involved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each block of pairs, the rows that are in a likely pair between groups."""
    for rows in _blocks_of_pairs(batches):
        found = sorted({i for _, *pair in _pairs_of(rows) for i in pair})
        if found:
            yield rows.iloc[found]


def _close(batches: Iterator[pd.DataFrame], shingle: int = SHINGLE) -> Iterator[pd.DataFrame]:
    """Sorted rows (key, x, y, band, block, id, comp, n, sig, text): links between different groups, block by block,
    the likeliest pairs first, and only while the rows' groups are not yet joined within the block."""
    for rows in _blocks_of_pairs(batches):
        ids, comp = rows["id"].to_numpy(), rows["comp"].to_numpy()
        sets = [s for _, texts in blocks(rows["text"], BLOCK_BYTES) for s in shingle_sets(texts, shingle)]
        group = {c: c for c in comp}

        def find(c, group=group):
            while group[c] != c:
                group[c] = c = group[group[c]]
            return c

        out = []
        for _, i, j in sorted(_pairs_of(rows)):
            a, b = find(comp[i]), find(comp[j])
            if a != b and _linked(sets[i], sets[j]):
                group[a] = b
                out.append((ids[i], ids[j]))
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(row's id, n_shingles, component_id): one row per row of ``df``. ``shingle``: words of a shingle."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = materialize(docs.mapInPandas(partial(_describe, shingle=shingle), "id long, n long, h1 long, h2 long, sig binary"), "dedup-rows")
    nodes = rows.where("n > 0 and id is not null")
    # Equal sets are one class; the least id stands for it.
    classes = materialize(nodes.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "dedup-classes")
    keys = classes.select("id", F.posexplode(F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])).alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n_members"), F.min("id").alias("leader")).where("n_members > 1")
    members = materialize(keys.join(shared, "key"), "dedup-members")
    star = members.where("id != leader").select("leader", F.col("id").alias("member")).distinct()
    sig = classes.select("id", "n", "sig")
    both = star.join(sig.withColumnsRenamed({"id": "leader", "n": "n1", "sig": "sig1"}), "leader").join(
        sig.withColumnsRenamed({"id": "member", "n": "n2", "sig": "sig2"}), "member")
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(SLOTS - 1)), F.lit(0), lambda acc, i: acc + F.when(
        F.substring(F.col("sig1"), 2 * i + 1, F.lit(2)) == F.substring(F.col("sig2"), 2 * i + 1, F.lit(2)), 1).otherwise(0))
    sizes = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * PERCENT
    pairs = materialize(both.where(sizes & (equal >= LEAST_EQUAL)).select("leader", "member").distinct(), "dedup-pairs")
    wanted = materialize(members.select("id").distinct(), "dedup-wanted")
    if wanted.count() <= BROADCAST_IDS:  # else the texts are shuffled by id
        wanted = F.broadcast(wanted)
    texts = materialize(docs.join(wanted, "id", "left_semi").dropDuplicates(["id", "text"]), "dedup-texts")
    reps = rows.join(classes.select("h1", "h2", F.col("id").alias("rep")), ["h1", "h2"], "left").select("id", "n", "rep")
    reps = materialize(reps.withColumn("rep", F.when(F.col("id").isNotNull(), F.col("rep"))), "dedup-reps")
    # An id with several texts joins their classes.
    several = reps.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a != most").select("id", "a")
    several = reps.join(several, "id").select("a", F.col("rep").alias("b")).where("a != b")
    links = materialize(confirm(pairs, texts, shingle).unionByName(several), "dedup-links")
    comp = _components(links)
    # Buckets that still hold more than one group: the pairs of others than the leader.
    grouped = members.join(comp, members["id"] == comp["node"], "left").select("key", "band", "n_members", "id", F.coalesce("component", "id").alias("comp"))
    open_keys = grouped.where("n_members > 2").groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least != most").select("key")
    rest = grouped.join(open_keys, "key", "left_semi").join(sig, "id")
    n_blocks = F.ceil(F.col("n_members") / GROUP_ROWS).cast("int")
    rest = rest.withColumn("block", F.pmod(F.hash("id"), n_blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    rest = rest.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "band", "block", "id", "comp", "n", "sig")
    dealt = lambda df: df.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "id")
    involved = materialize(dealt(rest).mapInPandas(_involved, rest.schema), "dedup-involved")
    more = materialize(dealt(involved.join(texts, "id")).mapInPandas(partial(_close, shingle=shingle), "a long, b long"), "dedup-more")
    if not more.isEmpty():
        comp = _components(links.unionByName(more))
    out = reps.join(comp, reps["rep"] == comp["node"], "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "id").alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with one document of each group: the one with the least id, once. Rows with a null id all stay."""
    found = materialize(groups(df, id_col, text, shingle).where("id is not null").select("id", (F.col("id") == F.col("component_id")).alias("kept")), "dedup-found")
    gone = materialize(found.where("not kept").select(F.col("id").alias("__gone")).distinct(), "dedup-gone")
    if gone.count() <= BROADCAST_IDS:  # else the texts are shuffled by id
        gone = F.broadcast(gone)
    out = df.join(gone, df[id_col] == gone["__gone"], "left_anti")
    if found.where("kept").groupBy("id").count().where("count > 1").isEmpty():
        return out
    return out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(out.where(F.col(id_col).isNull()))


def _components(links: DataFrame) -> DataFrame:
    """(node, component) of every id with a link."""
    links = materialize(links, "dedup-edges")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    return materialize(connected_components(ends, links), "dedup-components")
