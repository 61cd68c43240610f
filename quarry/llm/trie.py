"""Prefix trie of sequences by van Emde Boas recursion, as Spark joins and aggregations over flat rows.

Sequences are cut at half the greatest depth, their upper halves at a quarter
and their lower halves at three quarters, and so on; all cuts of one level of
that recursion are one Spark job, so the number of jobs grows with the
logarithm of the depth, and no task holds a sequence or a subtree.

* ``segments``: digests of aligned runs of 1, 2, 4, ... tokens, each of two
  halves.
* ``paths``: level by level, the prefix that ends at a cut is named by the name
  of the prefix at the upper end of its half and the digest of the run between
  them. Equal prefixes get equal names, whatever sequence they stand in.
* nodes are the distinct names; their counts come from one aggregation.
* ``grafted``: totals of subtrees, from the smallest blocks of depths to the
  whole: the roots of a lower forest add up at the cut node they hang on, and
  what has gathered there is added to the cut node's ancestors within the upper
  block, found on the path of one member.

Names are 128-bit MD5 digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.plans.storage import release

BLOCK_BITS = 16  # at most 2^16 sequence ids are joined to one text at a time
# Fixed value: the name of the empty prefix.
ROOT = b"\x00" * 16


def digest(*parts: Column) -> Column:
    """MD5 of the parts, as 16 bytes."""
    return F.unhex(F.md5(F.concat(*parts)))


def token(*columns: Column) -> Column:
    """One digest of several texts (null: empty); each is preceded by its length, so no two lists run together."""
    parts = []
    for c in columns:
        text = F.coalesce(c, F.lit("")).cast("binary")
        parts += [F.concat(F.octet_length(text).cast("string"), F.lit(":")).cast("binary"), text]
    return digest(*parts)


def positions(rows: DataFrame, group: str, order: list[Column], keep: list[str]) -> DataFrame:
    """``group``, ``pos`` (1-based place of each row in its group by ``order``) and ``keep``.

    Rows are range-partitioned and sorted as a whole, so a group may span many
    partitions; a row's place is its place in the partition plus the rows its
    group has in earlier ones (a row a group and partition).
    """
    sort = [F.col(group), *order]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    tagged = ranged.select(group, *keep, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    tagged = saved(tagged, "ordered")
    parts = tagged.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("at").alias("from"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    return tagged.join(parts, [group, "part"]).select(group, (F.col("at") - F.col("from") + F.col("before") + 1).alias("pos"), *keep)


def segments(tokens: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k, ``seq``, ``block`` and ``run``: the digest of tokens block * 2^k + 1 to (block + 1) * 2^k."""
    out = [tokens.select("seq", (F.col("pos") - 1).alias("block"), F.col("token").alias("run"))]
    for _ in range(1, levels):
        halves = out[-1].groupBy("seq", F.shiftright("block", 1).alias("up"))
        odd = F.col("block") % 2 == 1
        both = halves.agg(F.max(F.when(~odd, F.col("run"))).alias("left"), F.max(F.when(odd, F.col("run"))).alias("right"))
        whole = both.where(F.col("left").isNotNull() & F.col("right").isNotNull())
        out.append(saved(whole.select("seq", F.col("up").alias("block"), digest(F.col("left"), F.col("right")).alias("run")), "segments"))
    return out


def paths(tokens: DataFrame, members: DataFrame, levels: int) -> DataFrame:
    """``seq``, ``depth`` and ``name`` of every prefix, the empty one included."""
    runs = segments(tokens, levels)
    named = [saved(members.select("seq", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name")), "paths")]
    for k in range(levels - 1, -1, -1):
        upper = named[0]
        for rows in named[1:]:
            upper = upper.unionByName(rows)
        upper = upper.select("seq", F.shiftright("depth", k).alias("block"), "name")
        cut = runs[k].where(F.col("block") % 2 == 0).join(upper, ["seq", "block"])
        depth = F.shiftleft(F.col("block") + 1, k)
        named.append(saved(cut.select("seq", depth.alias("depth"), digest(F.col("name"), F.col("run")).alias("name")), "paths"))
    release(*runs[1:])
    out = named[0]
    for rows in named[1:]:
        out = out.unionByName(rows)
    return out


def grafted(nodes: DataFrame, path: DataFrame, levels: int, values: list[str]) -> DataFrame:
    """``name`` and the subtree sums of ``values``, for every node below the root.

    ``nodes``: name, depth, parent, seq (a member), values. A pass adds the
    lower half of every block of 2^(k+1) depths to its upper half: a row for
    each cut node and ancestor in the half block, so at most one for each row of
    ``path`` over all of them.
    """
    parts = [nodes.where(F.col("depth") > 0).select("name", "depth", "parent", "seq", *values)]
    for k in range(levels):
        half = 1 << k
        below = F.pmod(F.col("depth") - 1, F.lit(2 * half)) == half  # roots of the lower forests
        gathered = None
        for rows in parts:
            mine = rows.where(below)
            gathered = mine if gathered is None else gathered.unionByName(mine)
        # what hangs on a cut node, from its children's own values and all that was added to them
        known = [F.max(c).alias(c) for c in ("parent", "seq", "depth")]
        roots = gathered.groupBy("name").agg(*known, *[F.sum(v).alias(v) for v in values])
        cuts = roots.groupBy("parent").agg(F.min("seq").alias("seq"), F.max(F.col("depth") - 1).alias("cut"), *[F.sum(v).alias(v) for v in values])
        above = cuts.withColumn("depth", F.explode(F.sequence(F.col("cut") - (half - 1), F.col("cut"))))
        added = above.join(path, ["seq", "depth"]).groupBy("name").agg(F.max("depth").alias("depth"), *[F.sum(v).alias(v) for v in values])
        none = F.lit(None)
        parts.append(saved(added.select("name", "depth", none.cast("binary").alias("parent"), none.cast("long").alias("seq"), *values), "grafted"))
    every = parts[0]
    for rows in parts[1:]:
        every = every.unionByName(rows)
    return every.groupBy("name").agg(*[F.sum(v).alias(v) for v in values])


def end_digests(ends: DataFrame) -> DataFrame:
    """``name`` and the SHA-256 of its ``seq`` in ascending order, as decimal numbers joined by commas.

    Ids are sorted and joined in blocks of at most 2^16 by an aggregation; the
    digest, which only one process can take, streams over a name's joined blocks
    and holds one at a time.
    """
    block = F.shiftright("seq", BLOCK_BITS)
    ids = F.transform(F.array_sort(F.collect_list("seq")), lambda i: i.cast("string"))
    joined = ends.groupBy("name", block.alias("block")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sha, names, found = None, None, [], []
        for batch in batches:
            for who, ids in zip(batch["name"].to_pylist(), batch["ids"], strict=True):
                text = ids.as_py().encode()
                if who == name:
                    sha.update(b",")
                else:
                    if name is not None:
                        names.append(name)
                        found.append(sha.hexdigest())
                    name, sha = who, hashlib.sha256()
                sha.update(text)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], ["name", "ends"])
            names, found = [], []
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["name", "ends"])

    return joined.repartition("name").sortWithinPartitions("name", "block").select("name", "ids").mapInArrow(run, "name binary, ends string")


def prefix_trie(tokens: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of sequences.

    ``tokens``: ``seq`` (long), ``pos`` (1, 2, ... without gaps in a sequence),
    ``token`` (digest, see :func:`token`) and ``weight`` (long, the same for
    equal tokens). ``members``: ``seq``, one row for each sequence, also those
    without tokens. Returns per node: ``seq`` (smallest member), ``depth``,
    ``parent_seq`` (the parent's smallest member; root: null), ``n_members``,
    ``n_children``, ``n_leaves`` (childless nodes in its subtree), ``saved``
    (summed over its subtree, members less one times weight of the last token)
    and ``ends_sha256`` (of the members that end there, see
    :func:`end_digests`). Without members there are no nodes, root included.
    """
    tokens, members = saved(tokens.select("seq", "pos", "token", "weight"), "tokens"), saved(members.select("seq"), "members")
    deepest = tokens.agg(F.max("pos")).first()[0] or 0
    levels = max(deepest - 1, 0).bit_length() + (deepest > 0)  # 2^levels > deepest, or no level at all
    path = paths(tokens, members, levels)
    found = path.groupBy("name").agg(F.min("seq").alias("seq"), F.count("*").alias("n_members"), F.min("depth").alias("depth"))
    up = path.select("seq", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = tokens.select("seq", F.col("pos").alias("depth"), "weight")
    found = saved(found.join(up, ["seq", "depth"], "left").join(last, ["seq", "depth"], "left"), "nodes")
    children = found.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = found.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved": (F.col("n_members") - 1) * F.coalesce("weight", F.lit(0).cast("long")),
    })
    nodes = saved(nodes, "nodes")
    totals = saved(grafted(nodes, path, levels, ["n_leaves", "saved"]), "totals")
    # the root's subtree: itself and the trees of its children
    tops = totals.join(nodes.where(F.col("depth") == 1).select("name"), "name")
    whole = tops.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    root = whole.select(F.lit(ROOT).alias("name"), F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved"))
    totals = totals.unionByName(root)
    longest = tokens.groupBy("seq").agg(F.max("pos").alias("depth"))
    lengths = members.join(longest, "seq", "left").select("seq", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))
    ends = end_digests(lengths.join(path, ["seq", "depth"]).select("name", "seq"))
    owners = found.select(F.col("name").alias("parent"), F.col("seq").alias("parent_seq"))
    done = nodes.drop("n_leaves", "saved").join(totals, "name").join(ends, "name", "left").join(owners, "parent", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return done.select("seq", "depth", "parent_seq", "n_members", "n_children", "n_leaves", "saved", F.coalesce("ends", F.lit(empty)).alias("ends_sha256"))


def conversation_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns in order as ``seq``, ``pos``, ``token``, ``weight`` (code points of the text), and the conversations as ``seq``.

    Turns are ordered by number, null first; equal numbers by the digest of
    role and text, so repeated rows are repeated turns. A null role or text is
    empty. Rows without a conversation id belong to none and are left out;
    extra columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("seq"), F.col(turn_col).alias("turn"), token(F.col(role_col), text).alias("token"), F.length(text).cast("long").alias("weight")
    )
    turns = positions(rows, "seq", [F.asc_nulls_first("turn"), F.col("token")], ["token", "weight"])
    return turns, conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("seq")).distinct()


def share_beginnings(turns: DataFrame, members: DataFrame, group: int = 100, folds: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation c: the first h turns of c - c % ``group``, then its own behind its first h.

    h is the unsigned crc32 of c in decimal, modulo ``folds``. A conversation
    gives its beginning to at most ``group`` others, of less than ``folds`` turns.
    """
    turns = saved(turns, "turns")
    taken = F.crc32(F.col("seq").cast("string").cast("binary")) % folds
    plan = members.select("seq", (F.col("seq") - F.col("seq") % group).alias("base"), taken.alias("h"))
    heads = turns.where(F.col("pos") < folds)
    given = heads.withColumnRenamed("seq", "base")
    lent = plan.join(given, "base").where(F.col("pos") <= F.col("h")).select("seq", "pos", "token", "weight")
    sizes = heads.groupBy(F.col("seq").alias("base")).agg(F.max("pos").alias("size"))  # up to folds - 1, and h is no more
    shift = plan.join(sizes, "base", "left").select("seq", "h", F.least("h", F.coalesce("size", F.lit(0))).alias("lent"))
    own = turns.join(shift, "seq").where(F.col("pos") > F.col("h")).select("seq", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "token", "weight")
    return lent.unionByName(own), members
