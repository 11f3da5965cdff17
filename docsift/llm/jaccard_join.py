"""N-gram Jaccard join with token-combination prefixes.

Tokens are the hashed word shingles of a document. Two documents link when the
Jaccard similarity of their token sets reaches a threshold; the result is the
connected component of each document, with no link lost:

1. Chunks exchange their tokens and learn which ones another document holds. A
   token of one document only is a miss against any partner; a document with more
   such misses than the threshold allows links with nothing and is done.
2. Documents of equal sets become one class, represented by one row.
3. The representatives exchange tokens again and learn each token's frequency class
   (the bit length of its document count), which orders all tokens, rare ones
   first. A document's prefix is extended until it must share a signature with
   every possible partner: rare tokens are signatures by themselves; frequent
   ones are dealt to sub-classes by hash and every two of a sub-class make one,
   which costs one more token per sub-class.
4. Of the rows under a signature, all are verified against the one with the
   fewest tokens of its own, and components formed. Rows that are then in another
   component than that leader are verified against all others of other components
   under the signature. Pairs that sizes, misses or parity bits rule out are never
   formed.

A pair within one component needs no verification, so a large group of near copies
costs little more than one verification per member, not one per pair.

Defined cases: null or empty text has no tokens and links with nothing; a text of
fewer than ``n`` words has one token, the whole sequence; rows repeated in every
column are copies of each other; null doc_id is never the smallest unless alone;
other columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm import exchange as X
from docsift.llm import hashing as H
from docsift.llm.components import components
from docsift.llm.rows import numbered, without_rows
from docsift.llm.words import LOWER
from docsift.session import materialize

RARE = 32                      # tokens of at most so many documents are signatures by themselves
HOT_GROUPS = 1000
_TOKENS = ("chunk bigint, row bigint, doc_id bigint, n_shingles bigint, sum1 bigint, sum2 bigint, tokens binary")
PARITY = [f"p{i}" for i in range(4)]       # 64 bits each
_READY = "row bigint, size bigint, shared bigint, tokens binary, signatures array<bigint>, " + ", ".join(
    f"{p} bigint" for p in PARITY)


class Rule(NamedTuple):
    """Words in a shingle, and the least similarity as ``num / den``."""
    n: int = 5
    num: int = 4
    den: int = 5

    def least_overlap(self, size: int) -> int:
        """Tokens that a set of ``size`` must share with any partner."""
        return -(-self.num * size // self.den)

    def sizes(self, size: int) -> tuple[int, int]:
        return self.least_overlap(size), size * self.den // self.num

    def holds(self, common: int, size_a: int, size_b: int) -> bool:
        return self.den * common >= self.num * (size_a + size_b - common)

    def possible(self, a: str, b: str) -> Column:
        """Whether rows of the aliases ``a`` and ``b`` can link.

        They share at most the tokens that other rows hold, and differ in at least as many tokens as their
        parities (of the token count in each of 256 hash buckets) differ in bits.
        """
        x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
        differ = sum((F.bit_count(x(p).bitwiseXOR(y(p))) for p in PARITY), F.lit(0))
        most = F.least(x("shared"), y("shared"), F.floor((x("shared") + y("shared") - differ) / 2))
        return self.den * most >= self.num * (x("size") + y("size") - most)


def parity(tokens: np.ndarray) -> np.ndarray:
    bits = np.bincount((H.mixed(tokens) >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def token_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of all texts, text by text, and the text of each."""
    words, ends = H.words_of(texts, LOWER)
    counts = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(texts)), counts)
    h = H.windows(words, n)
    inside = doc[:len(h)] == doc[n - 1:n - 1 + len(h)]
    tokens, of = [h[inside]], [doc[:len(h)][inside]]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        for k in range(1, n):
            some = short[counts[short] == k]
            if len(some):
                base = np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))      # never like a shingle of n words
                tokens.append(H.mixed(H.windows(words, k)[ends[some] - k] + base))
                of.append(some)
    tokens, of = np.concatenate(tokens), np.concatenate(of)
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
    return tokens[new], of[new]


# ---- which tokens do several documents hold, and how many? -----------------------------------------------

def _counted(tokens: np.ndarray):
    """Distinct tokens of a chunk, sorted, how many documents hold each (255 at most), each token's number."""
    order, first, group = X.groups(tokens)
    which = np.empty(len(tokens), np.int64)
    which[order] = group
    count = np.minimum(np.diff(first, append=len(tokens)), 255).astype(np.uint8)
    return tokens[order][first], count, which


def _send(parts: int, tokens_of):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in X.tables(batches):
            keys, count, _ = _counted(tokens_of(table))
            yield X.block_batch(X.blocks(table["chunk"][0].as_py(), keys, [keys.astype(np.uint32), count], parts))

    return send


def _classes(table: pa.Table) -> pa.Table:
    """For each token sent, the bit length of its documents' number less one (0: a single document)."""
    (key, count), counts = X.unpacked(table["block"].to_pylist(), ["<u4", "u1"])
    order, first, group = X.groups(key)
    total = np.add.reduceat(count[order].astype(np.int64), first) if len(key) else count.astype(np.int64)
    out = np.empty(len(key), np.uint8)
    out[order] = np.ceil(np.log2(np.maximum(total, 1))).astype(np.uint8)[group]
    blocks = [b.tobytes() for b in np.split(out, np.cumsum(counts)[:-1])]
    return pa.table([table["chunk"], table["part"], pa.array(blocks, pa.binary())], ["chunk", "part", "block"])


def _classes_of(keys: np.ndarray, replies: pa.Table, parts: int) -> np.ndarray:
    out = np.zeros(len(keys), np.uint8)
    bounds = X.part_bounds(keys, parts)
    got = dict(zip(replies["part"].to_pylist(), replies["block"].to_pylist()))
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            if len(got.get(part, b"")) != b - a:
                raise RuntimeError("the documents changed between two readings; write them to a table first")
            out[a:b] = np.frombuffer(got[part], np.uint8)
    return out


def _shared_only(rule: Rule, parts: int):
    """Step 1: keep the tokens of documents that can link; the others' rows carry none."""
    def keep(docs: pa.Table, replies: pa.Table) -> pa.Table:
        texts = docs["text"].to_pylist()
        out = [[] for _ in range(4)]
        if texts:
            tokens, of = token_sets(texts, rule.n)
            keys, _, which = _counted(tokens)
            shared = (_classes_of(keys, replies, parts) > 0)[which]
            cuts = np.searchsorted(of, np.arange(len(texts) + 1))
            other = H.mixed(tokens ^ np.uint64(0xA0761D6478BD642F))
            for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                size = b - a
                able = size and int(shared[a:b].sum()) >= rule.least_overlap(size)
                out[0].append(size)
                out[1].append(int(tokens[a:b].sum(dtype=np.uint64).view(np.int64)))
                out[2].append(int(other[a:b].sum(dtype=np.uint64).view(np.int64)))
                out[3].append(tokens[a:b][shared[a:b]].tobytes() if able else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table([docs["chunk"], docs["row"], docs["doc_id"], *(pa.array(c, k) for c, k in zip(out, kinds))],
                        [f.split()[0] for f in _TOKENS.split(", ")])

    return keep


# ---- signatures ------------------------------------------------------------------------------------------

def sub_classes(level: int) -> int:
    """Into how many sub-classes frequent tokens are dealt for sets of 2**level tokens or more."""
    return max(1, (1 << level) // 8)


def signatures(rule: Rule, size: int, tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Signatures of a set of ``size``, of which ``tokens`` (rare first) are held by other rows too."""
    least = rule.least_overlap(size)
    misses = len(tokens) - least                     # still allowed among ``tokens``
    if misses < 0 or not size:
        return np.zeros(0, np.int64)
    low, high = rule.sizes(size)
    rare = int(np.searchsorted(classes, RARE.bit_length()))
    out = []
    for level in range(max(low, 1).bit_length() - 1, high.bit_length()):
        m = sub_classes(level)
        sub = tokens[rare:] % np.uint64(m)
        first_of_sub = np.zeros(len(sub), bool)      # the token that a sub-class costs
        first_of_sub[np.unique(sub, return_index=True)[1]] = True
        gain = np.concatenate([np.ones(rare, np.int64), (~first_of_sub).astype(np.int64)])
        end = int(np.searchsorted(np.cumsum(gain), misses + 1)) + 1
        out.append(tokens[:min(rare, end)])
        prefix, sub = tokens[rare:end], sub[:max(0, end - rare)]
        for s in np.unique(sub).tolist():
            members = np.sort(prefix[sub == s])
            i, j = np.triu_indices(len(members), 1)
            out.append(H.mixed(members[i] + H.mixed(members[j] ^ np.uint64(level + 1))))
    return np.unique(np.concatenate(out)).view(np.int64)


def _ready(rule: Rule, parts: int):
    """Step 3: tokens in the common order and the signatures of the rows that can still link."""
    def ready(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out = [[] for _ in range(5 + len(PARITY))]
        if docs.num_rows:
            sets = [np.frombuffer(t, "<u8") for t in docs["tokens"].to_pylist()]
            tokens = np.concatenate(sets)
            keys, _, which = _counted(tokens)
            classes = _classes_of(keys, replies, parts)[which]
            at = 0
            for row, size, own in zip(docs["row"].to_pylist(), docs["size"].to_pylist(), sets):
                c = classes[at:at + len(own)]
                at += len(own)
                order = np.lexsort((own, c))
                order = order[np.count_nonzero(c == 0):]
                marks = signatures(rule, size, own[order], c[order])
                if len(marks):
                    values = (row, size, len(order), np.sort(own[order]).tobytes(), marks, *parity(own[order]).tolist())
                    for column, value in zip(out, values):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())] + [pa.int64()] * len(PARITY)
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], [f.split()[0] for f in _READY.split(", ")])

    return ready


# ---- verification ----------------------------------------------------------------------------------------

def _verify(rule: Rule):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            columns = [batch[c].to_pylist() for c in ("tokens_a", "tokens_b", "size_a", "size_b")]
            for a, b, size_a, size_b in zip(*columns):
                both = np.concatenate([np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")])
                both.sort(kind="stable")
                links.append(rule.holds(int(np.count_nonzero(both[1:] == both[:-1])), size_a, size_b))
            pick = pa.array(links, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pick), batch["b"].filter(pick)], ["a", "b"])

    return verify


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("row").alias(x), F.col("size").alias(f"size_{x}"), F.col("tokens").alias(f"tokens_{x}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify(rule), "a bigint, b bigint")


def _pairs(left: DataFrame, right: DataFrame, rule: Rule, unlike: Column) -> DataFrame:
    """Distinct pairs under a common signature that can link, of the rows for which ``unlike`` holds."""
    a, b = left.alias("a"), right.alias("b")
    low, high = F.col("a.size") * rule.num, F.col("b.size") * rule.num
    fit = (low <= F.col("b.size") * rule.den) & (high <= F.col("a.size") * rule.den) & rule.possible("a", "b")
    joined = a.join(b, (F.col("a.mark") == F.col("b.mark")) & unlike & fit)
    return joined.select(F.least("a.row", "b.row").alias("a"), F.greatest("a.row", "b.row").alias("b")).distinct()


def _links(ready: DataFrame, rule: Rule) -> DataFrame:
    """Step 4: edges (a, b) that connect every component of the linked rows."""
    marks = ready.select("row", "size", "shared", *PARITY, F.explode("signatures").alias("mark"))
    own = F.min(F.struct(((F.col("size") - F.col("shared")) / F.col("size")).alias("own"), "row"))
    leaders = marks.groupBy("mark").agg(own.alias("best"), F.count("*").alias("n")).filter("n > 1")
    leaders = materialize(leaders.select("mark", F.col("best.row").alias("leader")), "leaders")
    marks = materialize(marks.join(leaders, "mark"), "marks")
    leading = marks.filter("row = leader")
    first = materialize(_linked(_pairs(marks, leading, rule, F.col("a.row") != F.col("b.row")), ready, rule), "links1")
    labels = components(first)
    label = F.coalesce("component", "row")
    marks = marks.join(labels, "row", "left").withColumn("component", label)
    marks = marks.join(marks.filter("row = leader").select("mark", F.col("component").alias("main")), "mark")
    marks = materialize(marks, "labelled")
    apart = marks.filter("component <> main")
    # a pair of two rows apart from their leader is formed twice, and made one by distinct()
    second = _linked(_pairs(apart, marks, rule, F.col("a.component") != F.col("b.component")), ready, rule)
    return first.unionByName(materialize(second, "links2"))


def _hot_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, n_rows: int) -> DataFrame:
    """``rows`` with their group's columns; the few largest groups are broadcast, so no task gets one whole."""
    hot_from = n_rows // HOT_GROUPS + 1
    hot = groups.filter(F.col(size) > hot_from)
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(
            groups.filter(F.col(size) <= hot_from), keys))


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """row, doc_id, n_shingles, class_id, component, component_id for every row of ``docs(doc_id, text)``.

    ``class_id`` is the smallest doc_id with the same set; ``row`` is the row's number (that of
    ``numbered`` documents, else as they were read), and ``component`` is a row that stands for the component.
    """
    chunks, parts = X.chunked(docs), X.n_parts(docs)
    sent = chunks.mapInArrow(_send(parts, lambda t: token_sets(t["text"].to_pylist(), rule.n)[0]), X.BLOCK)
    replies = X.settled(sent.groupBy("part").applyInArrow(_classes, X.BLOCK), "classes1")
    found = X.settled(chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _shared_only(rule, parts), _TOKENS), "tokens")
    narrow = found.select("row", "doc_id", "n_shingles", "sum1", "sum2", F.col("tokens").isNotNull().alias("able"))
    n_rows = narrow.count()

    # classes of equal sets
    sets = ["n_shingles", "sum1", "sum2"]
    able = narrow.filter("able")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    classes = materialize(able.groupBy(*sets).agg(best.alias("best"), F.count("*").alias("members")).select(
        *sets, F.col("best.doc_id").alias("class_id"), F.col("best.row").alias("class_row"), "members"), "classes")

    # representatives: frequencies, signatures, links
    reps = found.filter("tokens IS NOT NULL").join(classes.select(F.col("class_row").alias("row")), "row", "left_semi")
    reps = materialize(reps.select("row", F.col("n_shingles").alias("size"), "tokens"), "representatives")
    dealt = reps.withColumn("chunk", F.floor(F.monotonically_increasing_id() / X.CHUNK_ROWS))
    sent = dealt.mapInArrow(_send(parts, _stored), X.BLOCK)
    replies = sent.groupBy("part").applyInArrow(_classes, X.BLOCK)
    ready = materialize(dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _ready(rule, parts), _READY), "ready")
    labels = components(_links(ready, rule))

    # every class with its component, and the smallest doc_id of that
    labelled = classes.join(labels.select(F.col("row").alias("class_row"), "component"), "class_row", "left")
    labelled = materialize(labelled.withColumn("component", F.coalesce("component", "class_row")), "labelled")
    least = labelled.groupBy("component").agg(F.min("class_id").alias("component_id"), F.count("*").alias("n_classes"))
    labelled = materialize(_hot_join(labelled, least, ["component"], "n_classes", n_rows), "named")
    columns = ["row", "doc_id", "n_shingles", "class_id", "component", "component_id"]
    linked = _hot_join(able, labelled, sets, "members", n_rows).select(*columns)
    alone = narrow.filter("NOT able").select(
        "row", "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("row").alias("component"),
        F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _stored(table: pa.Table) -> np.ndarray:
    return np.concatenate([np.frombuffer(t, "<u8") for t in table["tokens"].to_pylist()])


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` with one row of each component (the smallest doc_id), all their columns.

    ``docs`` must be a table: rows are matched by their place in it.
    """
    docs = numbered(docs)
    result = materialize(jaccard_components(docs, rule), "components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = result.groupBy("component").agg(first).select(F.col("first.row").alias("row"))
    return without_rows(docs, result.select("row").join(kept, "row", "left_anti"))
