"""Repair of conversations by the cheapest edits that give alternating roles.

Each conversation is a lattice: a node is a number of turns taken and the role that came last, and an edit
(keep, change the role, delete, insert) is an arc with a whole-number cost. Shortest paths are found by the auction
algorithm (Bertsekas, 1991): a path grows along the cheapest arc while its end's price allows that, else the
price of its end rises and the path shrinks. Prices stay feasible for the dual problem, so every arc
of a cheapest repair is tight in the end, and the first one in alphabetical order is traced along tight arcs.

Long conversations are auctioned in stretches of a few turns, from the last to the first, each with the
final prices of the next one's entries as the costs beyond its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch

WHITE = " \t\n\x0b\f\r"

#: Costs of the edits; keeping a turn is free, a truncated turn that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Turns that are auctioned at a time, and turns whose edits form one row.
STRETCH = 8
BLOCK = 4096

# A turn in one letter: role (other, system, user, assistant) and fault (none, blank, duplicate, truncated).
_OTHER, _SYSTEM, _USER, _ASSISTANT = range(4)
_SOUND, _BLANK, _DUPLICATE, _CUT = range(4)
_FIRST = ord("A")

# States: the role that came last, or none. A conversation may end where there is none, or after an
# assistant; after a user one insertion is missing, after a system turn two.
_FINAL = (0, 2 * INSERT, INSERT, 0)
_FINAL_EDITS = ("", "II", "I", "")


def _arcs(letter: str | None, state: int) -> list[tuple[str, int, bool, int]]:
    """Edit, cost, whether the turn is used up, and the next state; in alphabetical order of edits."""
    wanted = _ASSISTANT if state == _USER else _USER
    insert = ("I", INSERT, False, wanted)
    if letter is None:
        return [insert]
    role, fault = divmod(ord(letter) - _FIRST, 4)
    found = [("D", DELETE, True, state), insert]
    if fault not in (_BLANK, _DUPLICATE):
        more = TRUNCATED if fault == _CUT else 0
        if role == wanted or (role == _SYSTEM and state == _OTHER):
            found.append(("K", more, True, role))
        found.append(("R", REROLE + more, True, wanted))
    return found


def _auction(letters: str, beyond: tuple[int, ...]) -> list[list[int]]:
    """Prices of all nodes by layer; those of the first layer are the exact costs from there on."""
    end = len(letters)
    price = [[0] * 4 for _ in range(end + 1)]
    for entry in range(4):
        path = [(0, entry)]
        while path:
            at, state = path[-1]
            if at == end:
                best, onward = beyond[state], None
            else:
                best, onward = min(
                    (cost + price[at + taken][to], (at + taken, to))
                    for _, cost, taken, to in _arcs(letters[at], state)
                )
            if price[at][state] < best:
                price[at][state] = best
                if len(path) > 1:
                    path.pop()
            elif onward is None:
                break
            else:
                path.append(onward)
    return price


def _tight(letters: str, price: list[list[int]], beyond: tuple[int, ...]) -> list[list[str]]:
    """For each node the edits that are tight and lead on to the end along tight arcs."""
    end = len(letters)
    open_end = [price[end][state] == beyond[state] for state in range(4)]
    found = [[""] * 4 for _ in range(end)]
    after = open_end
    for at in range(end - 1, -1, -1):
        here = [False] * 4
        # insertions lead to states of the same layer: to the user state, and from there to the assistant's
        for _ in range(3):
            for state in range(4):
                edits = ""
                for edit, cost, taken, to in _arcs(letters[at], state):
                    goes = after[to] if taken else here[to]
                    if goes and price[at][state] == cost + price[at + taken][to]:
                        edits += edit
                found[at][state], here[state] = edits, bool(edits)
        after = here
    return found


@lru_cache(maxsize=1 << 16)
def _stretch(letters: str, beyond: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Costs by entry state, and for each the first cheapest edits and the state they end in."""
    price = _auction(letters, beyond)
    tight = _tight(letters, price, beyond)
    traces = []
    for state in range(4):
        at, edits = 0, ""
        while at < len(letters):
            edit = tight[at][state][0]
            _, _, taken, state = next(arc for arc in _arcs(letters[at], state) if arc[0] == edit)
            at, edits = at + taken, edits + edit
        traces.append((edits, state))
    return tuple(price[0]), tuple(traces)


def cheapest(letters: str) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the cheapest repair, and per stretch the state before it and its edits."""
    stretches = [letters[k : k + STRETCH] for k in range(0, len(letters), STRETCH)]
    beyond, total, solved = _FINAL, 0, []
    for one in reversed(stretches):
        least = min(beyond)
        total += least
        entry, traces = _stretch(one, tuple(cost - least for cost in beyond))
        beyond = entry
        solved.append(traces)
    state, edits = 0, []
    for traces in reversed(solved):
        piece, after = traces[state]
        edits.append((state, piece))
        state = after
    if edits:
        edits[-1] = (edits[-1][0], edits[-1][1] + _FINAL_EDITS[state])
    return total + beyond[0], edits


def mark(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` (conv_id, turn, role, text) with ``pos``, ``block`` and ``letter``.

    ``pos`` gives the order by conversation and turn (NULL first; equal turns by content): rows are dealt out by
    range, so a conversation of any size spreads over tasks. A row's first fault counts: blank,
    duplicate (role and text stood earlier in the conversation), truncated.
    """
    scratch = Scratch(turns.sparkSession, "repair")
    content = F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length("role"), "role", "text")
    keyed = turns.select(
        "conv_id", "turn", "role", "text", F.sha2(content, 256).alias("same"), F.monotonically_increasing_id().alias("n")
    )
    order = ["conv_id", "turn", "same", "n"]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.write(sorted_rows.withColumn("pos", F.monotonically_increasing_id()).drop("n"), "turns")
    repeated = rows.groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1")
    marked = rows.join(repeated.select("same", "first"), "same", "left")
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = (
        F.when(last == "", _BLANK)
        .when(F.col("pos") > F.col("first"), _DUPLICATE)
        .when(last.isin(".", "!", "?"), _SOUND)
        .otherwise(_CUT)
    )
    role = F.coalesce(*[
        F.when(F.startswith("role", F.lit(initial)), code)
        for initial, code in (("s", _SYSTEM), ("u", _USER), ("a", _ASSISTANT))
    ], F.lit(_OTHER))
    return marked.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "pos",
        F.floor(F.col("pos") / BLOCK).alias("block"),
        F.char(_FIRST + 4 * role + fault).alias("letter"),
    )


_SOLVED = """conv_id long, block long, state int, edits string, cost long, blank long, duplicate long,
truncated long, illegal long"""


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block of each conversation; its cost stands in the first one."""
    legal = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}
    for batch in batches:
        out = []
        for conv_id, blocks in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "blocks")), strict=True):
            letters = "".join(block["letters"] for block in blocks)
            total, edits = cheapest(letters)
            codes = [divmod(ord(letter) - _FIRST, 4) for letter in letters]
            every = "".join(piece for _, piece in edits)
            at, done, taken, state = 0, 0, 0, 0
            for number, block in enumerate(blocks):
                own = len(block["letters"])
                entry, begun, used = state, at, 0
                last = number == len(blocks) - 1
                while at < len(every) and (used < own or last):
                    edit = every[at]
                    if edit != "I":
                        state = _after(edit, state, codes[done + used][0])
                        used += 1
                    else:
                        state = _after(edit, state, _OTHER)
                    at += 1
                faults = [fault for _, fault in codes[done : done + own]]
                pairs = zip(codes[max(done - 1, 0) : done + own - 1], codes[max(done, 1) : done + own], strict=True)
                out.append(
                    {
                        "conv_id": conv_id,
                        "block": block["block"],
                        "state": entry,
                        "edits": every[begun:at],
                        "cost": 0 if taken else total,
                        "blank": faults.count(_BLANK),
                        "duplicate": faults.count(_DUPLICATE),
                        "truncated": faults.count(_CUT),
                        "illegal": sum((a[0], b[0]) not in legal for a, b in pairs),
                    }
                )
                done, taken = done + own, 1
        yield pa.RecordBatch.from_pylist(out, _SOLVED_ARROW)


_SOLVED_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("state", pa.int32()), ("edits", pa.string())]
    + [(name, pa.int64()) for name in ("cost", "blank", "duplicate", "truncated", "illegal")]
)


def _after(edit: str, state: int, role: int) -> int:
    if edit == "D":
        return state
    return role if edit == "K" else (_ASSISTANT if state == _USER else _USER)


def solve(marked: DataFrame) -> DataFrame:
    """The edits of every conversation, a row per block of turns, with the block's faults.

    One letter per turn is gathered for a conversation, never its texts.
    """
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda t: t["letter"]), "")
    blocks = marked.groupBy("conv_id", "block").agg(letters.alias("letters"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "letters"))).alias("blocks"))
    return whole.mapInArrow(_solve, _SOLVED)


_EDITS = "conv_id long, pos long, step long, edit string, role string, text string"
_EDITS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("pos", pa.int64()), ("step", pa.int64())]
    + [(name, pa.string()) for name in ("edit", "role", "text")]
)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a block come before its turns, which then pass by one after the other."""
    edits, at, state, last = "", 0, 0, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["edits"] is not None:
                edits, at, state, last = row["edits"], 0, row["state"], row["left"]
                continue
            last -= 1
            used = False
            while at < len(edits) and (not used or last == 0):
                edit = edits[at]
                if used and edit != "I":
                    break
                used |= edit != "I"
                role = "assistant" if state == _USER else "user"
                state = _after(edit, state, " sua".find(row["role"][:1] or "?"))
                at += 1
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "pos": row["pos"],
                        "step": at,
                        "edit": edit,
                        "role": role if edit in "IR" else row["role"],
                        "text": "" if edit == "I" else row["text"],
                    }
                )
        yield pa.RecordBatch.from_pylist(out, _EDITS_ARROW)


def apply_edits(marked: DataFrame, solved: DataFrame) -> DataFrame:
    """One row per edit: conv_id, pos and step (its place), edit, and role and text after it.

    Deleted turns are listed as they were. A block's edits are sent to its turns, so that the
    turns of a large conversation stay spread over tasks and pass by as a stream.
    """
    size = F.length(F.regexp_replace("edits", "I", "")).cast("long")
    plans = solved.select("conv_id", "block", F.lit(-1).cast("long").alias("pos"), "edits", "state", size.alias("left"))
    both = marked.select("conv_id", "block", "pos", "role", "text").unionByName(plans, allowMissingColumns=True)
    dealt = both.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    return dealt.mapInArrow(_apply, _EDITS)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report of every conversation, and all edits (see :func:`apply_edits`).

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit. NULL roles and texts
    count as one space, rows without conv_id are one conversation. Rows with the same turn
    stand in an order by content; repeated rows are duplicates. An empty table gives two empty
    ones. Other columns are ignored.
    """
    space = F.lit(" ")
    plain = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    scratch = Scratch(turns.sparkSession, "repaired")
    marked = scratch.write(mark(plain), "marked")
    solved = scratch.write(solve(marked), "solved")
    wide = "decimal(38,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn")
    gaps = marked.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "edits")))
    faults = solved.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(pieces, lambda p: p["edits"]), "").alias("audit"),
    )
    report = gaps.join(faults, gaps["conv_id"].eqNullSafe(faults["conv_id"])).drop(faults["conv_id"])
    return report, apply_edits(marked, solved)


def digest(edits: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256`` of the turns that stay, ``role:text`` joined by line feeds.

    A conversation's turns pass its task as a stream; only the state of the hash is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, now = None, None
        for batch in batches:
            done = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if hashed is None or conv_id != now:
                    if hashed is not None:
                        done.append((now, hashed.hexdigest()))
                    hashed, now = hashlib.sha256(), conv_id
                else:
                    hashed.update(b"\n")
                hashed.update(f"{role}:{text}".encode())
            yield _digests(done)
        if hashed is not None:
            yield _digests([(now, hashed.hexdigest())])

    def _digests(done: list[tuple[int | None, str]]) -> pa.RecordBatch:
        ids = pa.array([conv_id for conv_id, _ in done], pa.int64())
        return pa.RecordBatch.from_arrays([ids, pa.array([one for _, one in done], pa.string())], names=["conv_id", "repaired_sha256"])

    kept = edits.where("edit <> 'D'").select("conv_id", "pos", "step", "role", "text")
    return (
        kept.repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos", "step")
        .mapInArrow(run, "conv_id long, repaired_sha256 string")
    )


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of ``conv_id:turn``; NULL is one space.

    Of 20 rows one is dropped, one loses its text, one its sentence ends, one is there twice and one
    gets the role of the user.
    """
    space = F.lit(" ")
    slot = F.crc32(
        F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    ) % 20
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), slot.alias("slot")
    ).where("slot <> 0")
    said: Column = F.when(F.col("slot") == 1, "").when(
        F.col("slot") == 2, F.translate("text", ".!?", "")
    ).otherwise(F.col("text"))
    times = F.sequence(F.lit(1), F.when(F.col("slot") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("slot") == 4, "user").otherwise(F.col("role")).alias("role"),
        said.alias("text"),
        F.explode(times).alias("time"),
    ).drop("time")
