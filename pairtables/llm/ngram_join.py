"""Documents whose sets of word n-grams are similar: keys of buckets, then a prefix-tree join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pairtables.llm.common import stored, text_key
from pairtables.llm.components import components
from pairtables.llm.trie import links

#: A shingle that this many documents of a read batch hold is a candidate for a common one,
#: and so is one of this share of a batch; the most common of them are ordered last.
COMMON_COUNT, COMMON_SHARE, MAX_COMMON = 8, 0.0008, 500_000
#: Documents before a batch's shingles are counted.
COUNT_BATCH = 10_000
#: Small blocks are packed into tasks of about so many members of sets. A block of more than
#: ``TASK_MEMBERS`` is cut; its cuts meet the first one, and what that does not link the others.
PACK_MEMBERS, TASK_MEMBERS = 100_000, 500_000
#: Up to so many texts are looked for by a broadcast list (some 30 MB); for more, texts are shuffled for it.
MAX_LISTED = 500_000
_TOP = np.uint64(1 << 63)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Shingler:
    """Hashed shingle sets; remembers a bounded number of words."""

    def __init__(self, n: int, most: int = 200_000):
        self.n, self.most, self.known = n, most, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes. bytes.lower and bytes.split see ASCII only."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known, hashes = self.known, np.empty(len(words), dtype=np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = xxhash.xxh3_64_intdigest(w)
                if len(known) < self.most:
                    known[w] = h
            hashes[i] = h
        width = min(self.n, len(words))
        if not width:
            return hashes
        out = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            out = (out ^ hashes[i : len(words) - width + 1 + i]) * _MIX[0]
            out ^= out >> np.uint64(29)
            out *= _MIX[1]
            out ^= out >> np.uint64(32)
        return np.unique(out)


def _ordered(found: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the global order: rare shingles by hash, then common ones, rarest first."""
    keys = found >> np.uint64(1)
    if len(common) and len(found):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        hit = common[at] == found
        keys[hit] = _TOP | rank[at[hit]]
        keys.sort()
    return keys


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _rows(texts: DataFrame, n: int) -> DataFrame:
    """Per document its number of shingles; and, with a null number, counts of common shingles."""
    names = ["_id", "_t1", "_t2", "_n", "_shingle", "_count"]

    def counted(sets: list[np.ndarray]) -> pd.DataFrame:
        distinct = {(len(s), s.tobytes()[:64]): s for s in sets}.values()
        every, count = np.unique(np.concatenate([*distinct, np.zeros(0, np.uint64)]), return_counts=True)
        many = count >= max(COMMON_COUNT, int(COMMON_SHARE * len(sets)))
        frame = pd.DataFrame({"_shingle": _signed(every[many]), "_count": count[many]})
        return frame.reindex(columns=names).astype({k: "Int64" for k in names})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, held = Shingler(n), []
        for b in batches:
            sets = [shingles(t) for t in b["_text"]]
            frame = b[["_id", "_t1", "_t2"]].assign(_n=[len(s) for s in sets], _shingle=None, _count=None)
            yield frame.astype({k: "Int64" for k in names})
            held += sets
            if len(held) >= COUNT_BATCH:
                yield counted(held)
                held = []
        yield counted(held)

    return texts.mapInPandas(run, ", ".join(f"{k} long" for k in names))


def _buckets(lack: int) -> int:
    """The least power of two of which three quarters, rounded up, are more than ``lack``."""
    buckets = 1
    while buckets - buckets // 4 <= lack:
        buckets *= 2
    return buckets


def _keys(ordered: np.ndarray, part: int, whole: int) -> np.ndarray:
    """Hashes of the buckets of a set with the most rare members; linked sets share one.

    Two linked sets, the smaller of x members, differ by d <= lack(x) = (whole - part) x / part
    members. Dealt by hash to B = _buckets(lack(x)) buckets, they have B - d or more buckets in
    common, for a member spoils one at most. Each set keeps the lack + 1 strongest of its buckets,
    B - B // 4 at most, and drops fewer than B - d, in an order that a bucket's number and content
    give: so both keep the strongest of those they have in common. A set is also dealt to the
    numbers of buckets of the smaller sets that may be linked with it. A key stands for some three
    to nine shingles at a similarity of nine tenths, so unlike sets rarely share one, however many
    there are. Below two thirds, where buckets would be empty, the keys are the single members of
    the first n - ceil(s n) + 1: linked sets share one of them.
    """
    size = len(ordered)
    if 3 * part < 2 * whole or not size:
        return ordered[: (whole - part) * size // whole + 1]
    mixed = (ordered ^ (ordered >> np.uint64(32))) * _MIX[0]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1]
    rare, out = ordered < _TOP, []
    lack, least = (whole - part) * size // part, -(-part * size // whole)
    buckets, fewest = _buckets(lack), _buckets((whole - part) * least // part)
    while buckets >= fewest:
        at = ((mixed >> np.uint64(1)) >> np.uint64(64 - buckets.bit_length())).astype(np.int64)
        content = np.zeros(buckets, dtype=np.uint64)
        np.add.at(content, at, mixed)
        order = np.lexsort((np.bincount(at, minlength=buckets), np.bincount(at[rare], minlength=buckets)))
        kept = order[-min(lack + 1, buckets - buckets // 4) :]
        keys = (content[kept] ^ (kept + buckets).astype(np.uint64) * _MIX[2]) * _MIX[0]
        out.append((keys ^ (keys >> np.uint64(31))) * _MIX[2])
        buckets //= 2
    return np.concatenate(out)


def _combined(keys: np.ndarray, texts: np.ndarray) -> pd.DataFrame:
    """The least text of each key of a batch, so that a key goes on once per batch however many
    texts have it. The others share a key of this batch alone with that text."""
    order = np.lexsort((texts, keys))
    keys, texts = keys[order], texts[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    low = texts[first][np.cumsum(first) - 1]
    other = np.unique(np.stack([low, texts], axis=1)[texts != low], axis=0)
    heads = np.unique(other[:, 0])
    batch = np.bitwise_xor.reduce(texts.view(np.uint64))
    own = (np.concatenate([other[:, 0], heads]).view(np.uint64) ^ batch) * _MIX[2]
    return pd.DataFrame(
        {
            "_key": _signed(np.concatenate([keys[first], own])),
            "_t1": np.concatenate([texts[first], other[:, 1], heads]),
        }
    )


def _prefixes(texts: DataFrame, n: int, part: int, whole: int, sent) -> DataFrame:
    """The keys of each set, combined by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, (common, rank) = Shingler(n), sent.value
        for b in batches:
            keys = [_keys(_ordered(shingles(t), common, rank), part, whole) for t in b["_text"]]
            sizes = [len(k) for k in keys]
            if sum(sizes):
                yield _combined(np.concatenate(keys), np.repeat(b["_t1"].to_numpy(), sizes))

    return texts.select("_text", "_t1").mapInPandas(run, "_key long, _t1 long")


def _read_common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MAX_COMMON`` shingles and their ranks, rarest first."""
    counts = rows.where("_shingle is not null").groupBy("_shingle").agg(F.sum("_count").alias("_count"))
    top = counts.orderBy(F.desc("_count"), "_shingle").limit(MAX_COMMON).toArrow()
    found = top["_shingle"].to_numpy().astype(np.int64).view(np.uint64)
    rank = np.uint64(MAX_COMMON) - np.arange(len(found), dtype=np.uint64)
    order = np.argsort(found)
    return found[order], rank[order]


def _blocks(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``_block``: sets that share a key are in one block, so linked ones are. Each
    key joins its sets to the least of them. Sets that share none have no link and are left
    out. Half of a text's hash stands for it here: texts that have that in common come into
    one block. The keys are dealt once; a key has one row per batch at most."""
    low = F.min("_t1").over(Window.partitionBy("_key"))
    found = components(entries.select(F.col("_t1").alias("a"), low.alias("b")))
    return nodes.join(found.withColumnRenamed("node", "_t1"), "_t1").select("node", F.col("component").alias("_block"))


def _cut(blocks: DataFrame, nodes: DataFrame, task_members: int) -> DataFrame:
    """The nodes in blocks, with the size of the block, into how many cuts it is dealt and which
    of them (``_own``) the node is in."""
    sized = blocks.join(nodes, "node")
    total = sized.groupBy("_block").agg(F.sum("_n").alias("_members"))
    cuts = F.ceil(F.col("_members") / task_members).cast("int")
    return sized.join(total, "_block").select(
        "node", "_rep", F.col("_t1").alias("_u1"), F.col("_t2").alias("_u2"), "_n", "_block", "_members",
        cuts.alias("_cuts"), F.pmod(F.xxhash64("node"), cuts).cast("int").alias("_own"),
    )


def _first_tasks(cut: DataFrame, task_members: int) -> DataFrame:
    """``node``, ``_part``, ``_task``: small blocks are packed into tasks; of a large one, each cut
    meets the first. A group of like sets is linked by that, and its sets are sent once, those of
    the first cut apart."""
    small = cut.where("_cuts = 1").agg(F.sum("_n")).first()[0] or 0
    packs = small // min(PACK_MEMBERS, task_members) + 1
    cuts, own = F.col("_cuts"), F.col("_own")
    meets = F.when(cuts == 1, F.array(own)).when(own == 0, F.sequence(F.lit(1), cuts - 1)).otherwise(F.array(own))
    part = F.xxhash64("_block", "_meet")
    return cut.withColumn("_meet", F.explode(meets)).select(
        "node", "_rep", "_u1", "_u2", part.alias("_part"),
        F.when(cuts > 1, part).otherwise(F.pmod(F.xxhash64("_block"), F.lit(packs))).alias("_task"),
    )


def _second_tasks(cut: DataFrame, found: DataFrame, task_members: int) -> DataFrame:
    """Tasks of the cuts that have not met, from the components found so far. Within the largest
    component of a block nothing is left to find, so only the sets outside it go to every cut, in
    as many pieces as they fill; a block that is one component has no more tasks."""
    named = cut.where("_cuts > 2").join(found, "node", "left").withColumn("_name", F.coalesce("component", "node"))
    sizes = named.groupBy("_block", "_name").agg(F.sum("_n").alias("_size"))
    largest = sizes.groupBy("_block").agg(F.max_by("_name", F.struct("_size", "_name")).alias("_largest"))
    named = named.where("_own > 0").join(largest, "_block").withColumn("_out", F.col("_name") != F.col("_largest"))
    pieces = named.where("_out").groupBy("_block").agg(F.ceil(F.sum("_n") / task_members).cast("int").alias("_pieces"))
    named, own = named.join(pieces, "_block"), F.col("_own")
    piece = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("_pieces")).cast("int")
    others = F.filter(F.sequence(F.lit(1), F.col("_cuts") - 1), lambda j: F.col("_out") & (j != own))
    meets = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("_pieces") - 1), lambda i: F.struct(i.alias("i"), own.alias("j"))),
        F.transform(others, lambda j: F.struct(piece.alias("i"), j.alias("j"))),
    )
    part = F.xxhash64("_block", "_meet.i", "_meet.j")
    spread = named.withColumn("_meet", F.explode(meets))
    return spread.select("node", "_rep", "_u1", "_u2", part.alias("_part"), part.alias("_task"))


def ngram_groups(
    docs: DataFrame, n: int = 3, part: int = 90, whole: int = 100, id_col: str = "doc_id", text_col: str = "text",
    task_members: int = TASK_MEMBERS,
) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_t1``, ``_t2`` (its text), ``n_shingles``,
    ``component_id`` (least id, null only if no document of the component has one), ``_group``
    (a number of the component, whatever its ids are; null for an empty set).

    Words are runs of non-blanks with A-Z lower-cased; a set holds the distinct runs of ``n``
    words, or all words as one run if there are fewer. Sets with ``whole`` * intersection >=
    ``part`` * union are linked; empty sets and null texts are alone (equal null ids with no
    words stay null). Ids are integers. An empty table gives no rows.

    Equal texts are one node. Each node sends keys, that hold some rare shingles each; common
    shingles (a list of bounded size, gathered from all documents) count least in their choice and
    are last in the order of the tree. Only texts that share a key are moved, once, to the task of
    their block, unless one block holds more than ``task_members``.
    """
    if not 2 * part >= whole >= part:
        raise ValueError("the similarity must be between a half and one")
    texts = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    ).withColumns(dict(zip(("_t1", "_t2"), text_key(F.col("_text")))))
    rows = stored(_rows(texts, n), "rows")
    each = rows.where("_n is not null").select("_id", "_t1", "_t2", "_n")
    nodes = each.where("_n > 0").groupBy("_t1", "_t2").agg(F.min("_id").alias("_rep"), F.first("_n").alias("_n"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sent = docs.sparkSession.sparkContext.broadcast(_read_common(rows))
    blocks = stored(_blocks(_prefixes(texts, n, part, whole, sent), nodes), "blocks")
    cut = stored(_cut(blocks, nodes, task_members), "cuts")
    one = (F.col("_t1") == F.col("_u1")) & (F.col("_t2") == F.col("_u2")) & F.col("_id").eqNullSafe(F.col("_rep"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        out, shingles, (common, rank) = [], Shingler(n), sent.value
        for _, block in group.drop_duplicates(["_part", "node"]).groupby("_part"):
            ids = block["node"].tolist()
            own = [_ordered(shingles(t), common, rank) for t in block["_text"]]
            out += [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in links(own, part, whole)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def linked(tasks: DataFrame) -> DataFrame:
        """The links that the tasks find. Texts take less room than their sets of hashes; the list
        of tasks is broadcast or hashed, so texts are not sorted for the join."""
        tasks = stored(tasks, "tasks")
        tasks = F.broadcast(tasks) if tasks.count() <= MAX_LISTED else tasks.hint("shuffle_hash")
        sent_on = texts.join(tasks, one).select("node", "_part", "_task", "_text")
        return stored(sent_on.groupBy("_task").applyInPandas(join, "a long, b long"), "links")

    edges = linked(_first_tasks(cut, task_members))
    found = components(edges)
    if not cut.where("_cuts > 2").isEmpty():
        found = components(edges.unionByName(linked(_second_tasks(cut, found, task_members))))
    member = nodes.join(found, "node").select("_t1", "_t2", "component", "_rep")
    least = member.groupBy("component").agg(F.min("_rep").alias("_least"))
    member = stored(member.join(least, "component").select("_t1", "_t2", "_least", "component"), "members")
    own = nodes.select("_t1", "_t2", "_rep", "node").join(member, ["_t1", "_t2"], "left").select(
        F.col("_t1").alias("_u1"), F.col("_t2").alias("_u2"), F.coalesce("_least", "_rep").alias("_least"),
        F.coalesce("component", "node").alias("_group"),
    )
    same = (F.col("_t1") == F.col("_u1")) & (F.col("_t2") == F.col("_u2"))
    return each.join(own, same, "left").select(
        "_id", "_t1", "_t2", F.col("_n").alias("n_shingles"),
        F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_id")).alias("component_id"), "_group",
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which each component keeps the document
    with the least id (of equal ids the least text, of equal texts one row), whether ids are null
    or repeated in other components or not; documents without words all stay."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).cast("long").alias("_i"),
        *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("_e1", "_e2"))],
        F.monotonically_increasing_id().alias("_row"),
    )
    groups = ngram_groups(docs, id_col=id_col, text_col=text_col, **settings)
    stay = groups.where("n_shingles > 0 and component_id <=> _id")
    # Of several texts of a component with the least id, and of repeated rows, the first stays.
    first = stay.groupBy("_group").agg(F.first("_id").alias("_id"), F.min(F.struct("_t1", "_t2")).alias("_t"))
    words = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    kept = packed.join(
        first, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_e1") == F.col("_t._t1")) & (F.col("_e2") == F.col("_t._t2"))
    )
    doc = F.col("_doc")
    single = kept.groupBy("_group").agg(F.min_by(doc, "_row").alias("_doc")).select("_doc.*")
    empty = docs.where(~F.coalesce(words, F.lit(False)))
    return single.unionByName(empty)


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    groups = ngram_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


ORACLE_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end) as g
  from w),
n as (select doc_id, count(*) as c from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 90 * (x.c + y.c - i)),
r as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from r join l on l.a = r.other)
select r.doc_id, coalesce(any_value(n.c), 0) as n_shingles, min(r.other) as component_id
from r left join n on n.doc_id = r.doc_id group by r.doc_id
"""
