"""Merkle manifest of a dataset, and proofs that climb it.

A row of documents is a leaf. Leaves of one source, in order of their ids, form a tree of sixteen
children per node; the sources' roots, in order of the sources, form one more such tree. All levels are built by
one aggregate each and stored as node rows that name their parent: a row holds its own digest, the digests of its
children (its *run*), and its place among its parent's children. Digests are kept as bytes and hashed
as hexadecimal text.

A recursive query climbs from every leaf to the root. At each step it joins the parent's row, puts
the leaf's own recomputed digest in its place of the run, hashes, and appends the rest of the run to the proof. All
leaves of a run share everything above it, so one of them carries that part for all and the proofs are put together at
the end.

Near the root all leaves pass the same few nodes. A node above more than 256 leaves is stored once per block of
256, so every join meets at most 256 rows per key, however large a source is. Leaves are numbered by
ranges of the sorted table, never by sorting a source in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import lower_ascii, materialise, query, table

FANOUT = 16
DIGEST_BYTES = 32
# Leaves that share one copy of the nodes above them: a power of the fan-out.
BLOCK = FANOUT**2
TOP = -1
TAMPER_EVERY = 5
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
LEVEL_LIMIT = "spark.sql.cteRecursionLevelLimit"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts' concatenated text, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(bytes_: Column) -> Column:
    return F.lower(F.hex(bytes_))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """``(doc_id, source, leaf, folded)``: the leaf's digest and that of the row as it is found now.

    A found row differs where ``every`` divides the CRC-32 of its id: capital ASCII letters of its text are
    lower-cased. A row without id is left as it is. Columns beyond the five are not read.
    """
    names = ("doc_id", "source", "lang", "n_chars")
    head = F.concat(*[_field(F.col(c)) for c in names])
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % every == 0, F.lit(False))
    leaf = digest(head, _field(F.col("text")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf.alias("leaf"),
        F.when(tampered, digest(head, _field(lower_ascii(F.col("text"))))).otherwise(leaf).alias("folded"),
    )


def ranges(rows: DataFrame, group: str | None, by: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The rows dealt by ranges of group and order and written, and one row per range and group in it.

    What lies before a range in its group is a sum over ranges, so no task sorts a group. Null is a
    group and comes first. ``parts``: ``_part, _group, _shift, n``, with ``n`` the group's size.
    """
    order = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + by]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({
        "_part": F.spark_partition_id(),
        "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        "_group": F.col(group) if group else F.lit(0),
    })
    ranged = materialise(ranged, label)
    parts = ranged.groupBy("_part", "_group").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("_group")
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    return ranged, materialise(
        parts.select("_part", "_group", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n")), f"{label}-parts"
    )


def place(ranged: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows with ``pos``, their place in their group from 0, and all that ``parts`` says of their group."""
    facts = parts.withColumnsRenamed({"_part": "_in", "_group": "_named"})
    near = (F.col("_part") == F.col("_in")) & F.col("_group").eqNullSafe(F.col("_named"))
    return (
        ranged.join(facts, near)
        .withColumn("pos", F.col("_row") + F.col("_shift"))
        .drop("_part", "_row", "_group", "_in", "_named", "_shift")
    )


def _at(tree: Column, level: Column, pos: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _down(column: str) -> Column:
    return F.shiftright(column, 4)


def _one_level_up(below: DataFrame, level: int) -> DataFrame:
    """Nodes over the runs of a level: ``(tree, pos, n, digest, run, level)``, for trees of more than one node there."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "digest")))
    run = F.aggregate(ordered, F.lit(b""), lambda so_far, node: F.concat(so_far, node["digest"]))
    return (
        below.where("n > 1")
        .groupBy("tree", _down("pos").alias("pos"))
        .agg(run.alias("run"), F.first("n").alias("n"))
        .select(
            "tree", "pos", F.ceil(F.col("n") / FANOUT).alias("n"), digest(as_hex(F.col("run"))).alias("digest"), "run",
            F.lit(level).alias("level"),
        )
    )


def build_levels(bottom: DataFrame, largest: int, label: str) -> list[DataFrame]:
    """All levels over ``(tree, pos, n, digest)``, each written, until every tree has one node."""
    levels, below = [], bottom
    while largest > 1:
        below = materialise(_one_level_up(below, len(levels) + 1), f"{label}-{len(levels) + 1}")
        levels.append(below)
        largest = -(-largest // FANOUT)
    return levels


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for df in frames:
        out = out.unionByName(df.select(*empty.columns))
    return out


class Manifest:
    """Leaves and parent-linked nodes of a table of documents.

    ``leaves``: ``doc_id, leaf, folded, tree, pos, up, slot``; ``nodes``: ``source_no, block, at, up, slot, digest,
    run``; ``up`` is the parent's ``at``, null at the root. Rows that share an id, or have none, are ordered
    by their digests; equal rows are leaves of their own. An empty table has neither leaves nor nodes.
    """

    def __init__(self, docs: DataFrame, every: int = TAMPER_EVERY):
        hashed = materialise(leaves(docs, every), "leaves")
        ranged, parts = ranges(hashed, "source", ["doc_id", "leaf"], "ordered")
        named = parts.groupBy("_group").agg(F.first("n").alias("n_leaves"))
        sources = materialise(
            place(*ranges(named.withColumnRenamed("_group", "name"), None, ["name"], "sources")).select(
                "name", "n_leaves", F.col("pos").alias("source_no"), F.col("n").alias("n_sources")
            ),
            "numbered",
        )
        size = sources.agg(F.max("n_leaves"), F.max("n_sources")).first()
        parts = parts.join(sources.drop("n_leaves"), F.col("_group").eqNullSafe(F.col("name"))).drop("name")
        rows = materialise(place(ranged, parts), "placed")
        bottom = rows.select(F.col("source_no").alias("tree"), "pos", "n", F.col("leaf").alias("digest"))
        inner = build_levels(bottom, size[0] or 0, "level")
        lone = bottom.where("n = 1").select("tree", "digest")
        roots = _union([df.where("n = 1") for df in inner], lone)
        roots = roots.join(sources, F.col("tree") == F.col("source_no")).select(
            F.lit(TOP).cast("long").alias("tree"), F.col("source_no").alias("pos"), F.col("n_sources").alias("n"), "digest"
        )
        top = build_levels(materialise(roots, "roots"), size[1] or 0, "top")

        no_link = F.lit(None).cast("struct<tree:long,level:int,pos:long>")

        def to_top(source_no: str) -> Column:
            return F.when(F.col("n_sources") > 1, _at(F.lit(TOP), F.lit(1), _down(source_no))).otherwise(no_link)

        def link(tree: str, level: Column, beyond: Column) -> Column:
            return F.when(F.col("n") > 1, _at(F.col(tree), level + 1, _down("pos"))).otherwise(beyond)

        def slot(beyond: Column) -> Column:
            return F.when(F.col("n") > 1, F.col("pos") % FANOUT).otherwise(beyond % FANOUT).cast("int")

        self.leaves = rows.select(
            "doc_id", "leaf", "folded", F.col("source_no").alias("tree"), "pos",
            link("source_no", F.lit(0), to_top("source_no")).alias("up"), slot(F.col("source_no")).alias("slot"),
        )
        facts = sources.select("source_no", "n_leaves", "n_sources")
        blocks = (F.col("n_leaves") - 1) / BLOCK
        self.nodes = materialise(self._inner(inner, facts, link, to_top, slot).unionByName(self._top(top, facts, blocks, link, no_link)), "nodes")

    def _inner(self, levels: list[DataFrame], facts: DataFrame, link, to_top, slot) -> DataFrame:
        """Nodes of the sources' trees, one row per block of leaves below them."""
        spark = facts.sparkSession
        empty = spark.createDataFrame([], "tree long, pos long, n long, digest binary, run binary, level int")
        covers = F.pow(F.lit(float(FANOUT)), F.col("level")).cast("long")
        first = F.col("pos") * covers
        last = F.least(first + covers, F.col("n_leaves")) - 1
        block = F.explode(F.sequence(F.floor(first / BLOCK), F.floor(last / BLOCK)))
        return _union(levels, empty).join(facts, F.col("tree") == F.col("source_no")).select(
            "source_no", block.alias("block"), _at(F.col("tree"), F.col("level"), F.col("pos")).alias("at"),
            link("tree", F.col("level"), to_top("source_no")).alias("up"), slot(F.col("source_no")).alias("slot"), "digest", "run",
        )

    def _top(self, levels: list[DataFrame], facts: DataFrame, blocks: Column, link, no_link: Column) -> DataFrame:
        """Nodes over the sources, one row per source below them and block of its leaves."""
        spark = facts.sparkSession
        empty = spark.createDataFrame([], "tree long, pos long, n long, digest binary, run binary, level int")
        steps = facts.select("*", F.explode(F.sequence(F.lit(1), F.lit(max(1, len(levels))))).alias("level"))
        steps = steps.withColumn("pos", F.floor(F.col("source_no") / F.pow(F.lit(float(FANOUT)), F.col("level"))))
        return _union(levels, empty).join(steps, ["level", "pos"]).select(
            "source_no", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(blocks))).alias("block"),
            _at(F.lit(TOP), F.col("level"), F.col("pos")).alias("at"),
            link("tree", F.col("level"), no_link).alias("up"), (F.col("pos") % FANOUT).cast("int").alias("slot"), "digest", "run",
        )


# A leaf that heads its run carries what all leaves of the run share: run, proof above it, and both roots.
CLIMB = f"""
with recursive climb as (
    select doc_id, leaf, tree, pos, slot as own_slot, up, slot, folded,
           cast(null as binary) as run,
           case when pos % {FANOUT} = 0 then cast('' as binary) end as above,
           case when pos % {FANOUT} = 0 then leaf end as subroot,
           case when pos % {FANOUT} = 0 then leaf end as root
    from {{leaves}}
    union all
    select c.doc_id, c.leaf, c.tree, c.pos, c.own_slot, n.up, n.slot,
           unhex(sha2(lower(hex(concat(
               substring(n.run, 1, {DIGEST_BYTES} * c.slot), c.folded,
               substring(n.run, {DIGEST_BYTES} * c.slot + {DIGEST_BYTES + 1})))), 256)) as folded,
           case when c.pos % {FANOUT} = 0 then coalesce(c.run, n.run) end as run,
           case when c.run is null then c.above
                else concat(c.above, substring(n.run, 1, {DIGEST_BYTES} * c.slot),
                            substring(n.run, {DIGEST_BYTES} * c.slot + {DIGEST_BYTES + 1})) end as above,
           case when c.pos % {FANOUT} = 0 then if(n.at.tree = {TOP}, c.subroot, n.digest) end as subroot,
           case when c.pos % {FANOUT} = 0 then n.digest end as root
    from climb c join {{nodes}} n
      on n.source_no = c.tree and n.block = c.pos div {BLOCK} and n.at = c.up
)
select * from climb where up is null
"""


def climb(manifest: Manifest) -> DataFrame:
    """One row per leaf that has arrived at the root, written. Trees have as many levels as their size asks
    for, and no limit on rows holds."""
    spark: SparkSession = manifest.nodes.sparkSession
    before = {key: spark.conf.get(key, None) for key in (ROW_LIMIT, LEVEL_LIMIT)}
    try:
        for key in before:
            spark.conf.set(key, "-1")
        return materialise(spark.sql(CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "climbed")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def verify(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every leaf, digests in hexadecimal."""
    arrived = climb(manifest)
    heads = arrived.where(F.col("above").isNotNull()).select(
        F.col("tree").alias("_tree"), _down("pos").alias("_run"), "run", "above", "subroot", "root"
    )
    every = arrived.select("doc_id", "leaf", "tree", "pos", "own_slot", "folded")
    both = every.join(heads, (F.col("tree") == F.col("_tree")) & (_down("pos") == F.col("_run")))
    before = F.substring("run", F.lit(1), F.col("own_slot") * DIGEST_BYTES)
    after = F.substring("run", F.col("own_slot") * DIGEST_BYTES + DIGEST_BYTES + 1, F.octet_length("run"))
    siblings = F.coalesce(F.concat(before, after), F.lit(b""))
    return both.select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        F.sha2(as_hex(F.concat(siblings, F.col("above"))), 256).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def _sql() -> str:
    """Every level written out: trees of up to 16^5 leaves a source and 16^3 sources."""
    h = "sha256({})".format
    coded = [f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    fields = " || ".join(coded) + " || coalesce(strlen({t}) || ':' || {t}, '-')"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = """xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, strlen(doc_id::varchar) + 1), lambda i: ascii((doc_id::varchar)[i])::bigint)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)))))"""
    ctes = [
        f"""tagged as (select row_number() over () as rid, *, coalesce({crc} % {TAMPER_EVERY} = 0, false) as tampered from documents)""",
        f"""hashed as (select rid, doc_id, source, {h(fields.format(t="text"))} as leaf,
            case when tampered then {h(fields.format(t=f"translate(text, '{upper}', '{upper.lower()}')"))} else {h(fields.format(t="text"))} end as folded
            from tagged)""",
        """c0 as (select rid, doc_id, source, leaf, folded, '' as proof, leaf as node,
            row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
            count(*) over (partition by source) as n from hashed)""",
        "a0 as (select source as tree, pos, n, leaf as digest from c0)",
    ]

    def levels(a: str, count: int):
        for k in range(count):
            ctes.append(f"""{a}{k + 1} as (select tree, pos // {FANOUT} as pos, (n + {FANOUT - 1}) // {FANOUT} as n,
                {h("string_agg(digest, '' order by pos)")} as digest, list(digest order by pos) as run
                from {a}{k} where n > 1 group by tree, pos // {FANOUT}, n)""")

    def steps(a: str, c: str, tree: str, count: int):
        for k in range(count):
            before, after = f"array_to_string(a.run[1:c.pos % {FANOUT}], '')", f"array_to_string(a.run[c.pos % {FANOUT} + 2:], '')"
            ctes.append(f"""{c}{k + 1} as (select c.* replace (
                    case when c.n > 1 then {h(f"{before} || c.folded || {after}")} else c.folded end as folded,
                    case when c.n > 1 then c.proof || {before} || {after} else c.proof end as proof,
                    coalesce(a.digest, c.node) as node, c.pos // {FANOUT} as pos, (c.n + {FANOUT - 1}) // {FANOUT} as n)
                from {c}{k} c left join {a}{k + 1} a on a.tree is not distinct from c.{tree} and a.pos = c.pos // {FANOUT} and c.n > 1)""")

    levels("a", 5)
    steps("a", "c", "source", 5)
    ctes.append("""roots as (select source, any_value(node) as subroot, row_number() over (order by source nulls first) - 1 as source_no,
        count(*) over () as n_sources from c5 group by source)""")
    ctes.append("t0 as (select 0 as tree, source_no as pos, n_sources as n, subroot as digest from roots)")
    levels("t", 3)
    ctes.append("""d0 as (select c5.rid, c5.doc_id, c5.leaf, c5.folded, c5.proof, r.subroot as node, r.subroot, 0 as tree, r.source_no as pos, r.n_sources as n
        from c5 join roots r on r.source is not distinct from c5.source)""")
    steps("t", "d", "tree", 3)
    return f"""with {", ".join(ctes)}
select doc_id, leaf, subroot, node as root, {h("proof")} as proof_sha256, folded as folded_root, folded = node as verified from d3"""


@query("op11_merkle_manifest", _sql())
def op11_merkle_manifest(spark, sf_dir):
    """Every document's proof against the manifest, every fifth document by hash tampered with."""
    return verify(Manifest(table(spark, sf_dir, "documents")))
