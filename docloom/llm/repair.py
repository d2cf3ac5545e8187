"""Operator 12, conversation structure repair: A* over the lattice of edits of a conversation's rows.

A node is (rows read, what the repaired roles end with); edges keep, rerole or delete the next row, or insert a turn.
Nodes leave the queue by (cost + heuristic, audit). The heuristic is a suffix sum: 2 for each row that must be deleted, and
2 for each truncated one, which costs 5 if it stays and 2 if it goes; it never is too high and never falls by more than an
edge costs, so the first audit to reach a node is the cheapest, and of the cheapest the least. Edits of one node read the
same rows, and inserts stand before a row's edit, so no audit of a node is the beginning of another, and comparing
beginnings compares the whole.

Rows come sorted by conversation and turn, and are read as a stream. A conversation is repaired SEGMENT rows at a time: the
search starts from the cheapest audit for each ending and gives the same again, each with the state of its digest, so a task
holds no more texts than a segment's, however long a conversation is. What stays whole is the audit, one character a
row, and the digest asks for one task a conversation. Rows seen earlier are found by a grouped minimum in Spark.

Defined results: null conv_id: one conversation; null turns come first and count in no gap; null role or text: one space;
rows of one turn: by role, then text; repeated rows: duplicates; a role's initial is its first character, an empty role has
none and can't be kept; an empty table gives no rows; long texts count whole; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5  # costs
TRUNCATED = 5  # for a truncated row that stays
SEGMENT, SEGMENT_CHARS = 512, 8 << 20
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles end with
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
DONE = (EMPTY, ASSISTANT)
LEGAL = {"su", "ua", "au"}
FINE, MUST_GO, CUT = range(3)  # faults, as the search sees them

Row = tuple[str, str, int]  # role, text, fault


def after(end: int, role: str) -> int | None:
    """What the roles end with when the row stays with its role; None if it can't."""
    if role[:1] == "s":
        return SYSTEM if end == EMPTY else None
    return NEXT[end] if role[:1] == ROLE[NEXT[end]][0] else None


@dataclass
class Path:
    """The cheapest audit for one ending, and the digest of the turns it keeps."""

    cost: int = 0
    audit: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    begun: bool = False


def search(rows: list[Row], starts: list[tuple[int, int]], last: bool) -> dict[int, tuple[int, int, str]]:
    """ending -> cost, which start, audit of these rows. starts: ending, cost, in the order of their audits.

    The last rows give the cheapest complete repair only; others give the cheapest for each ending.
    """
    n = len(rows)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if rows[i][2] != FINE else 0)
    queue: list = []
    for k, (end, cost) in enumerate(starts):
        heappush(queue, (cost + ahead[0], k, "", 0, end, cost))
    closed, found = set(), {}
    while queue:
        _, k, audit, i, end, cost = heappop(queue)
        if (i, end) in closed:
            continue
        closed.add((i, end))
        if i == n and (not last or end in DONE):
            found[end] = (cost, k, audit)
            if last:
                return found
            continue
        steps = [("I", i, NEXT[end], INSERT)]
        if i < n:
            role, _, fault = rows[i]
            steps.append(("D", i + 1, end, DELETE))
            if fault != MUST_GO:
                stays = TRUNCATED if fault == CUT else 0
                if (kept := after(end, role)) is not None:
                    steps.append(("K", i + 1, kept, KEEP + stays))
                steps.append(("R", i + 1, NEXT[end], REROLE + stays))
        for letter, j, to, more in steps:
            if (j, to) not in closed:
                heappush(queue, (cost + more + ahead[j], k, audit + letter, j, to, cost + more))
    return found


def repaired(rows: list[Row], audit: str, end: int) -> Iterator[tuple[str, str]]:
    """The turns that the audit makes of the rows, after roles that end with `end`."""
    left = iter(rows)
    for letter in audit:
        if letter == "I":
            end = NEXT[end]
            yield ROLE[end], ""
            continue
        role, text, _ = next(left)
        if letter == "K":
            end = after(end, role)
            yield role, text
        elif letter == "R":
            end = NEXT[end]
            yield ROLE[end], text


class Conversation:
    """Rows in order, one at a time; holds a segment's texts at most."""

    def __init__(self):
        self.paths: dict[int, Path] = {EMPTY: Path()}
        self.rows: list[Row] = []
        self.chars = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None  # the initial of the row before
        self.equal: tuple | None = None  # turn, role, text of the row before
        self.first = self.latest = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, later: bool) -> None:
        """later: an equal row has an earlier turn."""
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        solid = text.rstrip(SPACE)
        fault = FINE
        if not solid:
            fault, self.blank = MUST_GO, self.blank + 1
        elif later or self.equal == (turn, role, text):
            fault, self.duplicate = MUST_GO, self.duplicate + 1
        elif solid[-1] not in ".!?":
            fault, self.truncated = CUT, self.truncated + 1
        self.equal = (turn, role, text)
        self.rows.append((role, text, fault))
        self.chars += len(text)
        if len(self.rows) >= SEGMENT or self.chars >= SEGMENT_CHARS:
            self.advance(False)

    def advance(self, last: bool) -> None:
        starts = sorted(self.paths.items(), key=lambda x: x[1].audit)
        found = search(self.rows, [(end, p.cost) for end, p in starts], last)
        paths = {}
        for end, (cost, k, audit) in found.items():
            came, path = starts[k]
            digest, begun = path.digest.copy(), path.begun
            for role, text in repaired(self.rows, audit, came):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
            paths[end] = Path(cost, path.audit + audit, digest, begun)
        self.paths, self.rows, self.chars = paths, [], 0

    def result(self) -> tuple:
        self.advance(True)
        (path,) = self.paths.values()
        gaps = self.latest - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, path.cost, path.audit, path.digest.hexdigest()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame) -> DataFrame:
    """rows: conv_id, turn, role, text and copies, how often the row stands there (0: it only names its conversation).

    Returns a row for each conversation: faults, cost, audit and the digest of the repaired turns.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "copies").withColumn("mark", F.md5("text"))
    seen = (rows.filter("copies > 0").groupBy("conv_id", "role", "mark").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
            .filter("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first"))
    met = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")), "left")
    later = F.col("first").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first"))
    met = met.select("conv_id", "turn", "role", "text", "copies", later.alias("later"))
    ordered = met.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    kind = rows.schema["conv_id"].dataType

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        name, out = None, []

        def batch() -> pa.RecordBatch:
            ids = pa.array([i for i, _ in out], id_type)
            each = [pa.array([x[k] for _, x in out], pa.int64()) for k in range(len(COUNTS))]
            words = [pa.array([x[k] for _, x in out], pa.string()) for k in (len(COUNTS), len(COUNTS) + 1)]
            made = pa.RecordBatch.from_arrays([ids, *each, *words], ["conv_id", *COUNTS, "audit", "repaired_sha256"])
            out.clear()
            return made

        for b in it:
            id_type = b.schema.field("conv_id").type
            for conv, turn, role, text, copies, later in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "later")), strict=True):
                if now is None or conv != name:
                    if now is not None:
                        out.append((name, now.result()))
                        if len(out) >= 512:
                            yield batch()
                    now, name = Conversation(), conv
                for _ in range(copies):
                    now.add(turn, role, text, later)
        if now is not None:
            out.append((name, now.result()))
            yield batch()

    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the query damages them, with their number of copies."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), code.alias("code"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


QUERIES = {"op12_repair": op12_repair}

#: The same costs as a walk over rows: of each ending the cheapest audit, the least of equal ones, with its turns.
_FAR = 1_000_000_000


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _sql() -> str:
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, strlen(k) + 1), lambda i: ascii(substring(k, i, 1))::bigint)), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295::bigint)")

    def step(state: str, cost: str, letter: str, turn: str) -> str:
        text = f"{state}.t" if turn == "null" else f"list_append({state}.t, {turn})"
        return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', t := {text})"

    def inserts(of: str, to: str) -> str:
        user = _least(f"{of}2", *[step(f"{of}{e}", "5", "I", "'user:'") for e in (0, 1, 3)])
        assistant = _least(f"{of}3", step(f"{of}2", "5", "I", "'assistant:'"))
        return f"{of}0 as {to}0, {of}1 as {to}1, {user} as {to}2, {assistant} as {to}3"

    def stay(of: str, role: str, initial: str) -> list[str]:
        charge = f"case when o.must then {_FAR} else 0 end + case when o.cut then 5 else 0 end"
        keep = step(of, f"case when o.initial = '{initial}' then 0 else {_FAR} end + {charge}", "K", "o.role || ':' || o.text")
        return [keep] + ([step(of, f"1 + {charge}", "R", f"'{role}:' || o.text")] if role else [])

    def gone(of: str) -> str:
        return step(of, "2", "D", "null")

    return f"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
coded as (select conv_id, turn, role, text, {crc} % 20 as code from keyed),
made as (select conv_id, turn, case when code = 4 then 'user' else role end as role,
  case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case code when 0 then 0 when 3 then 2 else 1 end)) as copy from coded),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos from made),
flagged as (select *, row_number() over (partition by conv_id, role, text order by pos) > 1 as seen, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid from numbered),
rows_ as (select conv_id, turn, role, text, pos, left(role, 1) as initial, solid = '' as blank, solid <> '' and seen as dup, solid <> '' and not seen and right(solid, 1) not in ('.', '!', '?') as cut,
  solid = '' or seen as must, lag(left(role, 1)) over (partition by conv_id order by pos) as prev from flagged),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (dup) as duplicate,
  count(*) filter (cut) as truncated, count(*) filter (prev is not null and prev || initial not in ('su', 'ua', 'au')) as illegal, max(pos) as n from rows_ group by conv_id),
walk as (
  select conv_id, 0::bigint as pos, struct_pack(c := 0::bigint, a := '', t := []::varchar[]) as s0, struct_pack(c := {_FAR}::bigint, a := '', t := []::varchar[]) as s1,
    struct_pack(c := {_FAR}::bigint, a := '', t := []::varchar[]) as s2, struct_pack(c := {_FAR}::bigint, a := '', t := []::varchar[]) as s3 from counts
  union all
  select conv_id, pos, {gone('y0')}, {_least(gone('y1'), *stay('y0', '', 's'))}, {_least(gone('y2'), *[x for e in (0, 1, 3) for x in stay(f'y{e}', 'user', 'u')])}, {_least(gone('y3'), *stay('y2', 'assistant', 'a'))}
  from (select conv_id, pos, o, {inserts('x', 'y')} from (select w.conv_id, o.pos, o, {inserts('w.s', 'x')} from walk w join rows_ o on o.conv_id is not distinct from w.conv_id and o.pos = w.pos + 1))),
ended as (select conv_id, n, {inserts('x', 'y')} from (select w.conv_id, c.n, {inserts('w.s', 'x')} from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.pos)),
chosen as (select conv_id, {_least('y0', 'y3')} as b from ended),
ids as (select distinct conv_id from conversations)
select i.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate, coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal,
  coalesce(b.b.c, 0) as cost, coalesce(b.b.a, '') as audit, sha256(coalesce(array_to_string(b.b.t, chr(10)), '')) as repaired_sha256
from ids i left join counts c on c.conv_id is not distinct from i.conv_id left join chosen b on b.conv_id is not distinct from i.conv_id
"""


SQL = {"op12_repair": _sql()}
