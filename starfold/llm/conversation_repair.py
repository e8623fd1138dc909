"""Repair of the turn structure of conversations, with an audit of the edits.

A conversation's roles shall read (system? (user assistant)+)?, by their initials. The cheapest edits - keep K, rerole R, delete D,
insert I - are found by dynamic programming over the rows, with the states of that pattern: START, and after a system (S),
a user (U) or an assistant (A). Of equally cheap edits the audit that is least as a string wins.

*Persistent audits.* An audit is a linked node with its last edit, so audits share their prefixes, and an edit costs one
node. A node knows its ancestors 1, 2, 4 ... steps up and a rolling hash of its string. Two audits that tie are compared at the end of
their longest common prefix, found by halving over ancestors with equal hashes; equal hashes of different nodes
are verified letter by letter, and where one proves false, the audits are compared as strings.

*Long conversations.* Rows are range-partitioned by conversation and turn, so a conversation of any size is spread over tasks, and
cut into runs of bounded length. A run that doesn't begin its conversation is solved from every state. Its cheapest audits
for each pair of states are a small matrix; matrices are put together in order, with the same comparison, which gives the same audit
as one pass would: equally cheap audits between the same states never are prefixes of each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starfold.llm.carry import slices
from starfold.llm.tables import loose
from starfold.llm.text import BLANKS, hash_pair

START, S, U, A = STATES = range(4)
#: The state after a row that is kept, by the state before and the row's initial.
KEPT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: The state after a row that is inserted or reroled: a user, or an assistant after a user.
MADE = {START: U, S: U, U: A, A: U}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
RUN = 4_096
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Node:
    """An audit: the edits of ``up[0]`` and then ``edit`` (one letter, or a run's letters)."""

    __slots__ = ("edit", "hash", "depth", "up")

    def __init__(self, parent: Node | None, edit: str, code: int):
        self.edit = edit
        if parent is None:
            self.hash, self.depth, self.up = 0, 0, ()
            return
        self.hash, self.depth = (parent.hash * BASE + code + 1) % MODULUS, parent.depth + 1
        up, k = [parent], 0
        while len(up[k].up) > k:  # the ancestor 2 ** (k + 1) up is that of the ancestor 2 ** k up
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def extended(self, edit: str) -> Node:
        return Node(self, edit, ord(edit) if len(edit) == 1 else hash(edit) % MODULUS)

    def text(self) -> str:
        parts, node = [], self
        while node.up:
            parts.append(node.edit)
            node = node.up[0]
        return "".join(reversed(parts))


def above(node: Node, depth: int) -> Node:
    """The ancestor at that depth."""
    while node.depth > depth:
        node = node.up[(node.depth - depth).bit_length() - 1]
    return node


def equal(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth hold the same edits: what equal hashes say, verified."""
    while a is not b:
        if a.hash != b.hash or a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether audit a is less than b as a string."""
    depth = min(a.depth, b.depth)
    x, y = above(a, depth), above(b, depth)
    if x.hash == y.hash:
        if not equal(x, y):
            return a.text() < b.text()
        return a.depth < b.depth
    for k in reversed(range(len(x.up))):  # up to the last ancestors that differ: the common prefix ends above them
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    if not equal(x.up[0], y.up[0]):
        return a.text() < b.text()
    if x.edit.startswith(y.edit) or y.edit.startswith(x.edit):  # runs, of which one begins with the other
        return a.text() < b.text()
    return x.edit < y.edit


Best = dict[int, tuple[int, Node]]


def offer(best: Best, state: int, cost: int, parent: Node, edit: str) -> None:
    """``edit`` after ``parent`` becomes the audit of the state if it is cheaper, or as cheap and less."""
    known = best.get(state)
    if known is not None and known[0] < cost:
        return
    node = parent.extended(edit)
    if known is None or cost < known[0] or less(node, known[1]):
        best[state] = cost, node


def inserted(best: Best) -> Best:
    """After any insertions: a user, an assistant, or both; more in a row never pay."""
    out = dict(best)
    for state in (START, S, A, U):
        if state in out:
            cost, node = out[state]
            offer(out, MADE[state], cost + INSERT, node, "I")
    return out


def edited(best: Best, initial: str, deleted: bool, truncated: bool) -> Best:
    """After insertions and one row."""
    out: Best = {}
    for state, (cost, node) in inserted(best).items():
        offer(out, state, cost + DELETE, node, "D")
        if deleted:
            continue
        more = TRUNCATED if truncated else 0
        if (state, initial) in KEPT:
            offer(out, KEPT[state, initial], cost + KEEP + more, node, "K")
        offer(out, MADE[state], cost + REROLE + more, node, "R")
    return out


def finished(best: Best) -> tuple[int, str]:
    """The cheapest audit that ends after an assistant, or with nothing at all."""
    out = inserted(best)
    ends = [out[s] for s in (START, A) if s in out]
    cost, node = ends[0]
    for c, n in ends[1:]:
        if c < cost or c == cost and less(n, node):
            cost, node = c, n
    return cost, node.text()


def solve(rows: Iterable[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) of a conversation's rows (initial, has to go, truncated)."""
    best: Best = {START: (0, Node(None, "", 0))}
    for initial, deleted, truncated in rows:
        best = edited(best, initial, deleted, truncated)
    return finished(best)


def apply(audit: Iterable[str], rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows, one by one."""
    state, own = START, iter(rows)
    for edit in audit:
        if edit == "I":
            state = MADE[state]
            yield ("assistant" if state == A else "user"), ""
            continue
        role, text = next(own)
        if edit == "K":
            state = KEPT[state, role[:1]]
            yield role, text
        elif edit == "R":
            state = MADE[state]
            yield ("assistant" if state == A else "user"), text


# -- rows and their faults -----------------------------------------------------


def faults(rows: DataFrame) -> DataFrame:
    """One row for each different row of each conversation, without its text: how many equal ones there are and what is wrong.

    rows: (conv_id, turn, role, text), none of the last two null. A row is named by 128 bits of role and text. Equal rows with
    one turn are counted before they are shuffled; the first place of a (role, text) is found from those that occur again.
    """
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    h1, h2 = hash_pair(F.col("role"), F.col("text"))
    src = rows.select("conv_id", "turn", "role", F.crc32("text").alias("crc"), h1.alias("h1"), h2.alias("h2"), (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated"))
    each = src.groupBy(*src.columns).agg(F.count("*").alias("n"))
    # the hash is never null, so that the rows of a null conv_id join too
    conv = F.coalesce(F.xxhash64(F.lit(1), F.col("conv_id")), F.lit(0))
    seen = each.groupBy("conv_id", "h1", "h2").agg(F.count("*").alias("times"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")).where(F.col("times") > 1)
    seen = seen.select(conv.alias("conv"), F.col("conv_id").alias("same"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("first.turn").alias("first"), F.lit(True).alias("met"))
    on = (F.col("of") == F.col("conv")) & (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")) & F.col("conv_id").eqNullSafe(F.col("same"))
    both = each.withColumn("of", conv).join(loose(seen), on, "left")
    again = F.coalesce(F.col("met"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    return both.select(*each.columns, again.alias("again"))


PLACE = ["conv_id", "turn", "role", "crc", "h1", "h2"]


def placed(frame: DataFrame, *before: str) -> list:
    """A conversation's order: turns with nulls first, ties by role, crc32 of the text, and its hash."""
    return [F.col("conv_id").asc_nulls_first(), *before, F.col("turn").asc_nulls_first(), *PLACE[2:]]


def path_type() -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))


COUNTS = ["blank", "duplicate", "truncated", "illegal"]
LEGAL = {"su", "ua", "au"}


def run_of(rows: list[tuple], whole: bool) -> dict:
    """A run's counts, ends and cheapest audits: from START alone if it begins its conversation (``whole``), else from all states.
    rows: (turn, initial, blank, duplicate, truncated), repeated rows one by one."""
    out = dict.fromkeys(COUNTS, 0)
    for _, _, blank, duplicate, truncated in rows:
        out["blank"] += blank
        out["duplicate"] += duplicate and not blank
        out["truncated"] += truncated and not (blank or duplicate)
    initials = [r[1] for r in rows]
    out["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turns = [r[0] for r in rows if r[0] is not None]
    out |= {"first": initials[0], "last": initials[-1], "least": turns[0] if turns else None, "most": turns[-1] if turns else None, "turns": len(set(turns)), "paths": []}
    for start in [START] if whole else STATES:
        best: Best = {start: (0, Node(None, "", 0))}
        for _, initial, blank, duplicate, truncated in rows:
            best = edited(best, initial, blank or duplicate, truncated)
        out["paths"] += [{"start": start, "end": end, "cost": cost, "audit": node.text()} for end, (cost, node) in best.items()]
    return out


def runs(each: DataFrame, most: int = RUN) -> DataFrame:
    """The runs of all conversations, in the order of (part, block)."""
    kind, turn = each.schema["conv_id"].dataType, each.schema["turn"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("least", turn), T.StructField("most", turn), T.StructField("turns", T.LongType()), T.StructField("paths", path_type())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    src = each.repartitionByRange(*placed(each)).sortWithinPartitions(*placed(each))
    src = src.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "again", "truncated", "n")

    def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for conv, turn, initial, blank, again, truncated, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield conv, (turn, initial, blank, again, truncated)
                for _ in range(n - 1):
                    yield conv, (turn, initial, blank, True, truncated)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, out, first = TaskContext.get().partitionId(), 0, [], True
        for conv, group in groupby(rows_of(batches), key=itemgetter(0)):
            begins, held = not first, []  # the first conversation may have begun in the task before
            first = False
            for _, row in group:
                held.append(row)
                if len(held) >= most:
                    out.append({"conv_id": conv, "part": part, "block": block, **run_of(held, begins)})
                    begins, held, block = False, [], block + 1
            if held:
                out.append({"conv_id": conv, "part": part, "block": block, **run_of(held, begins)})
                block += 1
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return src.mapInArrow(run, schema)


def joined(pieces: Iterable[dict]) -> dict:
    """The counts, cost and audit of a conversation from its runs in order."""
    out = dict.fromkeys(COUNTS, 0)
    best: Best = {START: (0, Node(None, "", 0))}
    last = least = most = None
    turns = 0
    for piece in pieces:
        for c in COUNTS:
            out[c] += piece[c]
        if last is not None:
            out["illegal"] += last + piece["first"] not in LEGAL
        last = piece["last"]
        if piece["turns"]:
            turns += piece["turns"] - (most is not None and most == piece["least"])
            least, most = piece["least"] if least is None else least, piece["most"]
        after: Best = {}
        for path in piece["paths"]:
            if path["start"] in best:
                cost, node = best[path["start"]]
                offer(after, path["end"], cost + path["cost"], node, path["audit"])
        best = after
    cost, audit = finished(best)
    return {"gaps": most - least + 1 - turns if turns else 0, **out, "cost": cost, "audit": audit}


def audits(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = RUN) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation that has rows.

    A row's first fault counts: blank text, a (role, text) seen earlier in the conversation, a last letter other than
    ``.!?``. Blank and repeated rows have to go. gaps: whole numbers between the least and the largest turn that no row has; illegal:
    neighbouring rows whose initials are none of su, ua and au.

    Defined cases: a null role or text is one space; null turns come first and make no gap; ties go by role, crc32 of the
    text and its hash; a null conv_id is a conversation of its own; a role without a letter, or of another
    initial, can only be reroled or deleted; an empty table gives none; other columns are left out; a conversation of any length is
    solved in runs of ``most`` rows.
    """
    src = named(rows, conv_id, turn, role, text)
    pieces = runs(faults(src), most)
    pieces = pieces.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "block")
    names = ["gaps", *COUNTS, "cost"]
    schema = T.StructType([pieces.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in names), T.StructField("audit", T.StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        every = (row for batch in batches for i in range(0, batch.num_rows, 500) for row in batch.slice(i, 500).to_pylist())
        for conv, group in groupby(every, key=itemgetter("conv_id")):
            out.append({"conv_id": conv, **joined(group)})
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return pieces.mapInArrow(run, schema)


def named(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    return rows.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"))


def repaired(rows: DataFrame, audited: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, role, text): the rows after the edits of ``audited``, numbered from 0 in each conversation.

    A task reads its conversations in order, each after its audit, and passes the rows on one by one, so none is ever held.
    The rows of a conversation follow each other in one partition.
    """
    src = named(rows, conv_id, turn, role, text)
    none = F.lit(None)
    heads = audited.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"), F.lit(0).cast("long").alias("crc"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("audit").alias("text"))
    h1, h2 = hash_pair(F.col("role"), F.col("text"))
    own = src.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.crc32("text").alias("crc"), h1.alias("h1"), h2.alias("h2"), "text")
    both = heads.unionByName(own).repartition("conv_id")
    both = both.sortWithinPartitions(*placed(both, "kind")).select("conv_id", "kind", "role", "text")
    schema = T.StructType([both.schema["conv_id"], T.StructField("pos", T.LongType()), both.schema["role"], both.schema["text"]])
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for start, length in slices(batch.column(3), 1_000_000) for row in zip(*(c.to_pylist() for c in batch.slice(start, length).columns), strict=True))
        out, held = [], 0
        for conv, group in groupby(every, key=itemgetter(0)):
            audit = next(group)[3]
            for pos, (own_role, body) in enumerate(apply(audit, ((r[2], r[3]) for r in group))):
                out.append((conv, pos, own_role, body))
                held += len(body) + 50
                if held > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), arrow, strict=True)], names=schema.names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), arrow, strict=True)], names=schema.names)

    return both.mapInArrow(run, schema)


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` of all rows of ``repaired``, joined by line feeds. Rows follow each other as they come
    from there, so the digest takes them in one by one, without a shuffle."""
    schema = T.StructType([fixed.schema["conv_id"], T.StructField("sha256", T.StringType())])
    kind = to_arrow_type(schema[0].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        every = (row for batch in batches for start, length in slices(batch.column(3), 1_000_000) for row in zip(*(c.to_pylist() for c in batch.slice(start, length).columns), strict=True))
        out = []
        for conv, group in groupby(every, key=itemgetter(0)):
            digest = hashlib.sha256()
            for _, pos, role, text in group:
                digest.update((("\n" if pos else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            out.append((conv, digest.hexdigest()))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out])], names=schema.names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out])], names=schema.names)

    return fixed.mapInArrow(run, schema)
