"""Conversation repair against a shortest-path search over whole audits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from intake_spark.llm import conversations as C
from intake_spark.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, live_ string, fault int, chunk string"
LETTER = {0: "u", 1: "u", 2: "a", 3: "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        at = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if at == 0:
            continue
        row = (conv, turn, "user" if at == 4 else role, "" if at == 1 else re.sub("[.!?]", "", text) if at == 2 else text)
        out += [row, row] if at == 3 else [row]
    return out


def best(rows):
    """(cost, audit, lines) of rows (role, text, fault): the least by cost, then audit, of all ways."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        new, role = {0: 2, 1: 2, 2: 3, 3: 2}[state], "assistant" if state == 2 else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", i, new, (*lines, (role, ""))))
        if i < len(rows):
            r, text, fault = rows[i]
            extra = 5 if fault == "truncated" else 0
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, new, (*lines, (role, text))))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, r[:1]))
                if kept is not None:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kept, (*lines, (r, text))))


def plain(original, order):
    by = {}
    for r in damaged(original):
        by.setdefault(r[0], []).append(r)
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted(by.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], order(r[3]), r[3]))
        seen, faults = set(), []
        for _, _, role, text in rows:
            shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in rows if r[1] is not None}
        cost, audit, lines = best([(r[2], r[3], f) for r, f in zip(rows, faults, strict=True)])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def order_of(spark, texts):
    from pyspark.sql import functions as F

    return {r.text: r.h for r in spark.createDataFrame([(t,) for t in {*texts, "", " "}], "text string").select("text", F.xxhash64("text").alias("h")).collect()}


def table(seed, n=120, long=0):
    rng = random.Random(seed)
    rows = []
    text = lambda: rng.choice(["Yes.", "No!", "what", "", " \n", "Fine. \t", "ok? ", None, "ß…", "a.b", f"t{rng.random()}.", f"t{rng.random()}."])
    role = lambda: rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "unknown"])
    for conv in range(n):
        turns = sorted(rng.sample(range(14), rng.randint(1, 8)))
        rows += [(conv, t, ["user", "assistant"][i % 2] if rng.random() < 0.7 else role(), text()) for i, t in enumerate(turns)]
    rows += [(7, None, "user", "null turn."), (7, None, "user", "null turn."), (None, 1, "user", "x."), (None, 2, "assistant", "y."), (5, 3, "user", "a tie."), (5, 3, "user", "another tie."), (5, 3, "assistant", "tie.")]
    rows += [(1000, i, rng.choice(["user", "user", "assistant"]), rng.choice(["same.", f"m{i}.", "cut", ""])) for i in range(long)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "c") for r in rows], SCHEMA).repartition(parts)


def held(spark, got, rows):
    hashes = order_of(spark, {t for *_, t in damaged(rows)})
    assert sorted(((r.conv_id, (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)) for r in got), key=repr) == sorted(plain(rows, hashes.get).items(), key=repr)


def test_query(spark, tmp_path):
    rows = table(1)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    held(spark, got.collect(), rows)


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_long_conversations_in_chunks(spark, chunk_rows):
    rows = table(2, n=20, long=150)
    held(spark, C.repair(C.damage(frame(spark, rows)), chunk_rows=chunk_rows).collect(), rows)


def test_lines_are_those_of_the_digest(spark):
    rows = table(3, n=30, long=40)
    by = {}
    for r in sorted(C.repair(C.damage(frame(spark, rows)), lines=True, chunk_rows=7).collect(), key=lambda r: (r.chunk, r.report is not None)):
        lines, done = by.setdefault(r.conv_id, ([], []))
        lines.extend(f"{x.role}:{x.text}" for x in r.lines)
        done.extend([r.report] if r.report else [])
    assert len(by) == len({r[0] for r in rows})
    assert all(len(done) == 1 and hashlib.sha256("\n".join(lines).encode()).hexdigest() == done[0].repaired_sha256 for lines, done in by.values())


def test_runs_by_powers_are_as_row_by_row():
    rng = random.Random(4)
    for _ in range(300):
        symbols = b"".join(bytes([rng.randrange(12)]) * rng.choice([1, 1, 2, 5, 13]) for _ in range(rng.randint(0, 6)))
        rows = [("suax"[s % 4], "", {0: "", 4: "truncated", 8: "blank"}[s - s % 4]) for s in symbols]
        edits, cost = C.settled(symbols)
        assert (cost, edits) == best(rows)[:2]
    assert C.settled(bytes([1]) * 100_000)[1] == 50_000 and C.settled(b"") == ("", 0)


def test_empty_and_all_dropped(spark):
    assert C.repair(frame(spark, [], 1)).collect() == []
    gone = next(c for c in range(100) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = C.repair(C.damage(frame(spark, [(gone, 1, "user", "x.")], 1))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
