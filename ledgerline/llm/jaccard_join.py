"""Exact n-gram Jaccard join of whole texts by prefix trees, and the classes its links make.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of distinct
word n-grams. Method:

1. *Signatures*: one row per document with its set size and the key of the set, a 64-bit sum of its
   grams' hashes. Documents with equal sets are one vertex, the key, from here on.
2. *Global order*: the grams of distinct sets travel packed (numpy arrays per pack and hash bucket, 6 bytes a gram
   and the set's number in its pack). A bucket counts in how many sets each gram occurs and numbers the shared ones: rare grams first,
   ties by bucket and hash. Grams of a single set can't be in any intersection; they are
   only counted. Each shared gram also carries its *hub*, the smallest set that has it by a hash. A gram that
   many sets of a pack share (a line that a third of all documents have) is one entry with a count there;
   numbers come back to the packs, which hand them to their sets.
3. *Prefixes*: with overlap at least ``percent`` of its size, a partner shares one of the first
   ``size - ceil(percent * size) + 1`` grams of a document in the global order, whose head are the
   unshared ones. A document with too few shared grams is dropped here: it has no partner.
4. *Prefix trees*: both ends of a link meet at the hub of a shared prefix gram, so a document
   goes to the distinct hubs of its prefix. At a hub the globally ordered sets form a compressed
   trie; a probe walks it with one overlap count per shared path, and leaves a subtree when the
   remaining lengths can't reach the needed overlap or all its sets already share the probe's
   class. A hub with many members (a third of all rows may be near copies) is cut into chunks,
   each of which gets the hub's pivot document; members that don't join the pivot's class are
   then probed against every other chunk, so no link is lost. A chunk holds a bounded number of sets; the probes that come to
   it are as many as the hub has such members.
5. *Classes*: connected components of the links (large-star / small-star).

Grams are compared by 55 or more bits of a 64-bit hash inside a bucket; texts are never cut.

Rows: null or blank texts have the empty set, link with nothing and are their own class; a null
id takes no part in links and gets a null class; a repeated row is in the class of its first one;
rows that repeat an id with another text are documents of their own. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.components import components
from ledgerline.llm.docgroups import cuts
from ledgerline.llm.scratch import Scratch, rename_clear

GRAMS_PER_BUCKET = 2_000_000      # memory of one bucket task, whatever the corpus size
GRAMS_PER_FLUSH = 1_500_000       # grams a map task packs before it sends them
HOT_SETS = 64                     # sets of a pack that share a gram, from which on it is sent with a count
CHUNK = 256                       # members of a hub that one trie holds
U64 = np.uint64


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, k1 = [], []
            for _, _, g, ptr in K.shingle_sets(b.column("text"), n):
                size.append(np.diff(ptr))
                k1.append(K.segment_sum(g, ptr))
            if size:
                own = {"digest": b.column("digest")} if "digest" in b.schema.names else {}
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id"), "n_grams": np.concatenate(size),
                    "k1": np.concatenate(k1).view(np.int64), **own})
    return run


def signatures(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, n_grams, k1) of every row of ``docs(doc_id, text)``, and its digest if it has one."""
    return docs.mapInArrow(_signatures(n), "doc_id long, n_grams long, k1 long" + ", digest string" * ("digest" in docs.columns))


def text_digest(text: str) -> Column:
    """What tells texts under one id apart; a null is a text of its own."""
    return F.coalesce(F.md5(F.col(text)), F.lit(""))


def _pack_grams(n: int, n_buckets: int):
    """Grams of the distinct sets of a batch, packed by bucket: sets as steps, counts, 48-bit hashes.

    Sets have numbers inside their pack, as few bits as these need travel with the grams; the keys stay with
    the pack, in a row that only passes through. So does which sets have a gram that many of the pack
    share: such a gram goes to its bucket once, with its count.
    """
    def flush(parts):
        keys, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
        sizes = np.concatenate([np.diff(p[2]) for p in parts])
        starts = np.concatenate([p[2][:-1] + base for p, base in zip(
            parts, np.cumsum([0] + [len(p[1]) for p in parts[:-1]]), strict=True)])[first]
        sizes = sizes[first]
        doc = np.repeat(np.arange(len(keys)), sizes)
        g = np.concatenate([p[1] for p in parts])[np.repeat(starts, sizes) + np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        rows = {c: [] for c in PACKED.names}

        def send(**values):
            for c in PACKED.names:
                rows[c].append(values.get(c))

        def hashes(x):
            low = K.mix64(x)              # bits independent of those that chose the bucket
            return {"low": low.astype(np.uint32).tobytes(), "high": (low >> U64(48)).astype(np.uint16).tobytes()}
        number = int(K.mix64(np.array([K.segment_sum(keys.view(U64), np.array([0, len(keys)]))[0]], U64)).view(np.int64)[0])
        send(bucket=number % n_buckets, kind=KEYS, pack=number, docs=keys.tobytes(), counts=sizes.astype(np.uint32).tobytes())
        by_gram = np.argsort(g, kind="stable")
        head = np.flatnonzero(np.concatenate([[True], np.diff(g[by_gram]) != 0]))
        df = np.diff(np.append(head, len(g)))
        common = df >= HOT_SETS
        if common.any():
            own = by_gram[np.repeat(common, df)]
            send(bucket=number % n_buckets, kind=MEMBERS, pack=number, docs=doc[own].astype(np.uint32).tobytes(), grams=g[own].tobytes())
            grams, counts = g[by_gram[head[common]]], df[common]
            least = np.minimum.reduceat(_names(number, doc[own]), np.cumsum(counts) - counts)
            for key, s, e in cuts(_bucket(grams, n_buckets)):      # grams ascend, so do buckets
                send(bucket=key, kind=SUMS, pack=number, grams=grams[s:e].tobytes(), counts=counts[s:e].astype(np.uint32).tobytes(),
                     docs=least[s:e].tobytes(), **hashes(grams[s:e]))
            rest = np.sort(by_gram[np.repeat(~common, df)])
            g, doc = g[rest], doc[rest]
        bucket = _bucket(g, n_buckets)
        order = np.argsort(bucket * max(len(keys), 1) + doc, kind="stable")
        g, doc, bucket = g[order], doc[order], bucket[order]
        for b, s, e in cuts(bucket):
            head = np.flatnonzero(np.diff(doc[s:e], prepend=-1))
            send(bucket=b, kind=PLAIN, pack=number, docs=_small(np.diff(doc[s:e][head], prepend=0)),
                 counts=_small(np.diff(np.append(head, e - s))), **hashes(g[s:e]))
        return pa.RecordBatch.from_pydict(rows, schema=PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            valid_all = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for i, j, g, ptr in K.shingle_sets(b.column("text"), n):
                keys = K.segment_sum(g, ptr).view(np.int64)
                keep = np.flatnonzero(valid_all[i:j] & (np.diff(ptr) > 0))
                keep = keep[np.sort(np.unique(keys[keep], return_index=True)[1])]
                if not len(keep):
                    continue
                sizes = np.diff(ptr)[keep]
                to = np.concatenate([[0], np.cumsum(sizes)])
                take = np.repeat(ptr[keep], sizes) + np.arange(to[-1]) - np.repeat(to[:-1], sizes)
                parts.append((keys[keep], g[take], to))
                held += len(take)
                if held >= GRAMS_PER_FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
                    K.trim()
        if parts:
            yield flush(parts)
        parts = b = None                 # an idle worker keeps nothing
        K.trim()
    return run


def _bucket(g: np.ndarray, n_buckets: int) -> np.ndarray:
    return (((g >> U64(32)) * U64(n_buckets)) >> U64(32)).astype(np.int64)


def _small(x: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs; the first byte tells how many."""
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if int(x.max(initial=0)) <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _unsmall(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _names(pack: int, local: np.ndarray) -> np.ndarray:
    """A 32-bit hash for each set of a pack, to find the smallest set of a gram by (chance meetings only add members)."""
    return K.mix64(local.astype(U64) + K.mix64(np.array([pack], np.int64).view(U64))).astype(np.uint32)


PLAIN, SUMS, MEMBERS, KEYS = 0, 1, 2, 3      # grams of sets; counts of a pack's common grams; the sets that have them; the sets
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("pack", pa.int64()), ("docs", pa.binary()),
                    ("counts", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("grams", pa.binary())])
PACKED_DDL = "bucket int, kind byte, pack long, docs binary, counts binary, low binary, high binary, grams binary"
SHARED = pa.schema([("kind", pa.int8()), ("pack", pa.int64()), ("docs", pa.binary()), ("sizes", pa.binary()),
                    ("toks", pa.binary()), ("hubs", pa.binary()), ("grams", pa.binary())])
SHARED_DDL = "kind byte, pack long, docs binary, sizes binary, toks binary, hubs binary, grams binary"


def _number_grams(key, table):
    """One bucket: document frequency, global number and hub of each shared gram, sent back to the packs."""
    bucket = key[0].as_py()
    rows = {c: [] for c in SHARED.names}

    def send(**values):
        for c in SHARED.names:
            rows[c].append(values.get(c))
    kinds = table.column("kind").to_pylist()
    packs, docs, counts, lows, highs, grams = (table.column(c).to_pylist() for c in ("pack", "docs", "counts", "low", "high", "grams"))
    entries = []                                               # (row, local sets or None, grams, how many sets, smallest set)
    for r, kind in enumerate(kinds):
        if kind in (MEMBERS, KEYS):                            # passing through
            send(kind=kind, pack=packs[r], docs=docs[r], grams=grams[r], sizes=counts[r])
            continue
        gram = np.frombuffer(lows[r], np.uint32).astype(U64) | (np.frombuffer(highs[r], np.uint16).astype(U64) << U64(32))
        if kind == PLAIN:
            local = np.repeat(np.cumsum(_unsmall(docs[r])), _unsmall(counts[r]))
            entries.append((r, local, gram, np.ones(len(gram), np.int64), _names(packs[r], local)))
        else:                                                  # a common gram of a pack counts for all its sets
            entries.append((r, None, gram, np.frombuffer(counts[r], np.uint32).astype(np.int64), np.frombuffer(docs[r], np.uint32)))
    if entries:
        gram, count, name = (np.concatenate([e[c] for e in entries]) for c in (2, 3, 4))
        order = np.argsort(gram, kind="stable")
        g = gram[order]
        head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        df = np.add.reduceat(count[order], head)
        hub = np.minimum.reduceat(name[order], head)
        # rare first: the class of a gram is the bit length of its frequency
        rank = np.empty(len(head), np.int64)
        rank[np.argsort(df, kind="stable")] = np.arange(len(head))
        number = (np.floor(np.log2(df)).astype(np.int64) << 56) | (np.int64(bucket) << 28) | rank
        which = np.empty(len(g), np.int64)
        which[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(g))))
        at = 0
        for r, local, gram, _, _ in entries:
            w = which[at:at + len(gram)]
            at += len(gram)
            if local is None:
                send(kind=SUMS, pack=packs[r], grams=grams[r], toks=number[w].tobytes(), hubs=hub[w].tobytes())
                continue
            shared = df[w] > 1
            if shared.any():
                w = w[shared]
                send(kind=PLAIN, pack=packs[r], docs=local[shared].astype(np.uint32).tobytes(), toks=number[w].tobytes(), hubs=hub[w].tobytes())
    K.trim()
    return pa.Table.from_pydict(rows, schema=SHARED)


CAND = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("toks", pa.binary()), ("hubs", pa.list_(pa.int64()))])
CAND_DDL = "doc_id long, n long, toks binary, hubs array<long>"


def _needed(n: int, percent: int) -> int:
    """Smallest overlap of a set of n grams with any partner."""
    return -(-percent * n // 100)


def _prefixes(percent: int):
    """One pack: the sets' shared grams in global order, and the hubs of their prefixes; sets with too few go."""
    def run(table):
        kinds = table.column("kind").to_pylist()
        by = {c: table.column(c).to_pylist() for c in SHARED.names[2:]}

        def all_of(column, kind, t):
            return np.concatenate([np.frombuffer(x, t) for x, k in zip(by[column], kinds, strict=True) if k == kind] + [np.zeros(0, t)])
        at = kinds.index(KEYS)                                # packs of equal sets are equal: any of their rows
        keys, sizes = np.frombuffer(by["docs"][at], np.int64), np.frombuffer(by["sizes"][at], np.uint32).astype(np.int64)
        grams, toks, hubs = all_of("grams", SUMS, U64), all_of("toks", SUMS, np.int64), all_of("hubs", SUMS, np.uint32)
        order = np.argsort(grams, kind="stable")
        own = order[np.searchsorted(grams[order], all_of("grams", MEMBERS, U64))]
        doc = np.concatenate([all_of("docs", PLAIN, np.uint32), all_of("docs", MEMBERS, np.uint32)]).astype(np.int64)
        tok = np.concatenate([all_of("toks", PLAIN, np.int64), toks[own]])
        hub = np.concatenate([all_of("hubs", PLAIN, np.uint32), hubs[own]])
        order = np.lexsort((tok, doc))
        doc, tok, hub = doc[order], tok[order], hub[order]
        once = np.ones(len(doc), bool)                        # equal packs send their grams again
        once[1:] = (doc[1:] != doc[:-1]) | (tok[1:] != tok[:-1])
        doc, tok, hub = doc[once], tok[once], hub[once]
        rows = {c: [] for c in CAND.names}
        for d, s, e in cuts(doc):
            n = int(sizes[d])
            if e - s < _needed(n, percent):
                continue
            prefix = n - _needed(n, percent) + 1 - (n - (e - s))
            for c, x in zip(CAND.names, (int(keys[d]), n, tok[s:e].tobytes(), np.unique(hub[s:s + prefix]).astype(np.int64)), strict=True):
                rows[c].append(x)
        K.trim()
        return pa.Table.from_pydict(rows, schema=CAND)
    return run


class PrefixTree:
    """Compressed trie over globally ordered gram arrays; finds links of a probe with earlier sets."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int):
        self.percent, self.sets, self.sizes = percent, sets, np.asarray(sizes, np.int64)
        self.label = np.arange(len(sets))
        # node: (depth, end, lo, hi, children); sets lo..hi-1 share grams up to ``end``
        self.root = self._build(0, len(sets), 0) if sets else None

    def _common(self, lo: int, hi: int, depth: int) -> int:
        a, b = self.sets[lo][depth:], self.sets[hi - 1][depth:]
        m = min(len(a), len(b))
        diff = np.flatnonzero(a[:m] != b[:m])
        return depth + (int(diff[0]) if len(diff) else m)

    def _build(self, lo: int, hi: int, depth: int):
        root = [depth, 0, lo, hi, []]
        todo = [root]
        while todo:
            node = todo.pop()
            d, _, a, b, kids = node
            end = node[1] = self._common(a, b, d)
            node.append(int(self.sizes[a:b].min()))
            node.append(max(len(self.sets[k]) for k in range(a, b)))
            start = a
            while start < b and len(self.sets[start]) == end:   # sets that end here sort first
                start += 1
            while start < b:
                head, stop = self.sets[start][end], start + 1
                while stop < b and self.sets[stop][end] == head:
                    stop += 1
                kid = [end, 0, start, stop, []]
                kids.append(kid)
                todo.append(kid)
                start = stop
        return root

    def _overlap(self, n: int, m: int) -> int:
        return -(-self.percent * (n + m) // (100 + self.percent))

    def probe(self, x: np.ndarray, n: int, upto: int, mine: int | None = None) -> list[int]:
        """Link the probe with sets below ``upto`` that aren't yet in its class; returns new links."""
        found, own = [], mine
        todo = [(self.root, 0)] if self.root else []
        while todo:
            node, hit = todo.pop()
            depth, end, lo, hi, kids, low_n, most = node
            if lo >= upto:
                continue
            if own is not None and (self.label[lo:min(hi, upto)] == self.label[own]).all():
                continue
            need = self._overlap(n, low_n)
            seg = self.sets[lo][depth:end]
            if len(seg):
                at = np.searchsorted(x, seg)
                hit += int((x[np.minimum(at, len(x) - 1)] == seg).sum())
                left = len(x) - int(np.searchsorted(x, seg[-1], side="right"))
            else:
                left = len(x)
            for k in range(lo, min(hi, upto)):        # sets that end at this node
                if len(self.sets[k]) != end:
                    break
                if hit >= self._overlap(n, int(self.sizes[k])) and (own is None or self.label[k] != self.label[own]):
                    found.append(k)
                    if own is None:
                        own = k
                    else:
                        self.label[self.label == self.label[k]] = self.label[own]
            if hit + min(left, most - end) < need:
                continue
            todo.extend((kid, hit) for kid in reversed(kids))
        return found


def _ordered(members):
    return sorted(members, key=lambda m: (m[2].tolist(), m[0]))


def _link_chunk(members, percent: int):
    """Links inside one chunk, as stars to the smallest id of each class: [(u, v)], class of each id."""
    members = _ordered(members)
    tree = PrefixTree([m[2] for m in members], [m[1] for m in members], percent)
    for k, (_, n, x) in enumerate(members):
        tree.probe(x, n, k, mine=k)
    least: dict[int, int] = {}
    for k, m in enumerate(members):
        c = int(tree.label[k])
        least[c] = min(m[0], least.get(c, m[0]))
    return [(m[0], least[int(tree.label[k])]) for k, m in enumerate(members)]


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("hub", pa.int64()), ("chunk", pa.int64()), ("open", pa.bool_())])
LINKS_DDL = "u long, v long, hub long, chunk long, open boolean"


def _stream_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]):
    """Consecutive rows with equal keys, across batch borders; rows come sorted by the keys."""
    held_key, held = None, []
    for b in batches:
        for row in b.to_pylist():
            k = tuple(row[c] for c in keys)
            if k != held_key:
                if held:
                    yield held_key, held
                held_key, held = k, []
            held.append(row)
    if held:
        yield held_key, held


def _join_chunks(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {c: [] for c in LINKS.names}
        for (hub, chunk), members in _stream_groups(batches, ("hub", "chunk")):
            if len(members) < 2:
                continue
            pairs = _link_chunk([(m["doc_id"], m["n"], np.frombuffer(m["toks"], np.int64)) for m in members], percent)
            klass = dict(pairs)
            pivot = klass.get(members[0]["pivot"])
            several = members[0]["n_chunks"] > 1
            for u, v in pairs:
                is_open = several and v != pivot
                if u != v or is_open:
                    for c, x in zip(LINKS.names, (u, v, hub, chunk, is_open), strict=True):
                        rows[c].append(x)
            if len(rows["u"]) > 5000:
                yield pa.RecordBatch.from_pydict(rows, schema=LINKS)
                rows = {c: [] for c in LINKS.names}
        yield pa.RecordBatch.from_pydict(rows, schema=LINKS)
    return run


def _probe_chunks(percent: int):
    """Open members of other chunks probe one chunk of the same hub."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (hub, chunk), members in _stream_groups(batches, ("hub", "chunk")):
            sets = {False: [], True: []}
            for m in members:
                sets[m["probe"]].append((m["doc_id"], m["n"], np.frombuffer(m["toks"], np.int64)))
            index = _ordered(sets[False])
            rows = {c: [] for c in LINKS.names}
            tree = PrefixTree([m[2] for m in index], [m[1] for m in index], percent)
            for i, n, x in sets[True]:
                tree.label = np.arange(len(index))      # each probe for itself: a link to each class it meets
                for k in tree.probe(x, n, len(index)):
                    for c, val in zip(LINKS.names, (i, index[k][0], hub, chunk, False), strict=True):
                        rows[c].append(val)
            yield pa.RecordBatch.from_pydict(rows, schema=LINKS)
    return run


def _by_chunk(assigned: DataFrame, cand: DataFrame) -> DataFrame:
    """Bring the gram sets to (hub, chunk): sets move once by document, then to their chunks."""
    parts = assigned.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sent = assigned.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in assigned.columns if c != "doc_id"])).alias("to"))
    rows = cand.select("doc_id", "n", "toks").join(sent, "doc_id").select("doc_id", "n", "toks", F.explode("to").alias("t"))
    return (rows.select("doc_id", "n", "toks", "t.*").repartition(int(parts), "hub", "chunk")
            .sortWithinPartitions("hub", "chunk"))


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    percent: int = 80, keyed: bool = False) -> DataFrame:
    """Class of every row: (doc_id, n_shingles, component_id); see the module text for all cases.

    With ``keyed`` also the key of the class (null for the empty set) and the digest of the text, as several
    classes can have the same smallest id where ids repeat.
    """
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(docs.sparkSession, "jaccard")
    sig = scratch.store(signatures(docs.withColumn("digest", text_digest("text")) if keyed else docs, n), "signatures")
    sets = sig.filter((F.col("n_grams") > 0) & F.col("doc_id").isNotNull()).groupBy("k1").agg(
        F.max("n_grams").alias("n_grams"), F.min("doc_id").alias("least"))
    links = link_sets(scratch, docs, n, percent, int(sig.agg(F.sum("n_grams")).first()[0] or 0))
    comp = scratch.store(components(scratch, links), "components")
    named = scratch.store(sets.join(comp, F.col("k1") == F.col("id"), "left").select(
        "k1", "least", F.coalesce("component", "k1").alias("class")), "classes")
    label = named.groupBy("class").agg(F.min("least").alias("component_id"))
    key = ["class"] if keyed else []
    labelled = named.join(label, "class").select("k1", "component_id", *key)
    out = sig.withColumn("k1", F.when(F.col("n_grams") > 0, F.col("k1"))).join(labelled, "k1", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n_grams").alias("n_shingles"), own.alias("component_id"), *key, *["digest"] * keyed)


def link_sets(scratch: Scratch, docs: DataFrame, n: int, percent: int, total: int) -> DataFrame:
    """Links (u, v) between the keys of distinct sets that span every class of similar sets."""
    n_buckets = max(1, math.ceil(total / GRAMS_PER_BUCKET) * 2)
    grams = docs.mapInArrow(_pack_grams(n, n_buckets), PACKED_DDL)
    shared = grams.groupBy("bucket").applyInArrow(_number_grams, SHARED_DDL)
    # a set that several packs hold is the same candidate in each
    cand = scratch.store(shared.groupBy("pack").applyInArrow(_prefixes(percent), CAND_DDL).dropDuplicates(["doc_id"]), "candidates")
    at = cand.select(F.explode("hubs").alias("hub"), "doc_id")
    # stored, so that the join below has two plain sides and splits a hub that is hot
    hubs = scratch.store(at.groupBy("hub").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("pivot")).filter("c > 1").select(
        "hub", "pivot", F.ceil(F.col("c") / CHUNK).alias("n_chunks")), "hubs")
    placed = at.join(hubs, "hub").select(
        "hub", "doc_id", "pivot", "n_chunks", F.pmod(F.xxhash64("doc_id"), F.col("n_chunks")).alias("chunk"))
    everywhere = F.when(F.col("doc_id") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)).otherwise(
        F.array("chunk"))
    assigned = scratch.store(placed.select("hub", "doc_id", "pivot", "n_chunks", F.explode(everywhere).alias("chunk")), "chunks")
    links = scratch.store(_by_chunk(assigned, cand).mapInArrow(_join_chunks(percent), LINKS_DDL), "links")
    still = links.filter("open").select(F.col("u").alias("doc_id"), "hub", "chunk")
    out = links.filter("u <> v").select("u", "v")
    if still.limit(1).count():
        wide = assigned.filter("n_chunks > 1")
        probes = still.join(wide.select("hub", "doc_id", "n_chunks", "chunk"), ["hub", "doc_id", "chunk"]).select(
            "doc_id", "hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)).alias("to"), "chunk").filter(
            "to <> chunk").select("doc_id", "hub", F.col("to").alias("chunk"), F.lit(True).alias("probe"))
        index = wide.join(still.select("hub").distinct(), "hub", "left_semi").select(
            "doc_id", "hub", "chunk", F.lit(False).alias("probe"))
        second = scratch.store(_by_chunk(index.unionByName(probes), cand).mapInArrow(_probe_chunks(percent), LINKS_DDL), "probes")
        out = out.unionByName(second.select("u", "v"))
    return out
