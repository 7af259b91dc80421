"""Conversation repair against a plain search over all edits."""
import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelens.llm import queries, repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, mark int, place int, audit string"


def plain_search(rows):
    """Layer by layer, every edit from every state; no heap, no meeting."""
    best = {0: (0, "")}
    for k in range(len(rows) + 1):
        for _ in range(6):                                # insertions, until none is cheaper
            for q, (c, a) in list(best.items()):
                label = (c + 2, a + "I")
                best[repair.ADDED[q]] = min(best.get(repair.ADDED[q], label), label)
        if k == len(rows):
            break
        initial, gone, cut = rows[k]
        new = {}
        for q, (c, a) in best.items():
            edits = [(q, c + 3, "D")]
            if not gone:
                edits.append((repair.ADDED[q], c + 2 + cut, "R"))
                if (q, initial) in repair.KEPT:
                    edits.append((repair.KEPT[q, initial], c + cut, "K"))
            for to, cost, e in edits:
                new[to] = min(new.get(to, (cost, a + e)), (cost, a + e))
        best = new
    return min(best[q] for q in (0, 3) if q in best)


def plain(turns, damaged):
    rows = {}
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        out = rows.setdefault(conv, [])
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        text = "" if f == 1 else "".join(x for x in text if x not in ".!?") if f == 2 else text
        out += [(turn, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    result = {}
    for conv, out in rows.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, counts, lattice = set(), dict(blank=0, duplicate=0, truncated=0), []
        for _, role, text in out:
            fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(WHITE)[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            lattice.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        t = [r[0] for r in out if r[0] is not None]
        cost, audit = plain_search(lattice)
        lines, k, state = [], 0, 0
        for e in audit:
            if e == "I":
                state = repair.ADDED[state]
                lines.append({2: "user:", 3: "assistant:"}[state])
                continue
            if e == "K":
                state = repair.KEPT[state, out[k][1][:1]]
                lines.append(out[k][1] + ":" + out[k][2])
            elif e == "R":
                state = repair.ADDED[state]
                lines.append({2: "user:", 3: "assistant:"}[state] + out[k][2])
            k += 1
        result[conv] = (max(t) - min(t) + 1 - len(set(t)) if t else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                        sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(lattice, lattice[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", " ", "x", ""]), st.booleans(), st.integers(0, 1)), max_size=9)


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_search_equals_all_edits(rows):
    assert repair.search(rows) == plain_search(rows)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.integers(1, 4))
def test_folded_segments_equal_one_search(rows, n):
    best = {0: (0, "")}
    for k in range(0, len(rows), n):
        best = repair.follow(best, repair.paths(rows[k:k + n]))
    if not rows:
        best = repair.follow(best, repair.paths([]))
    assert min(best[q] for q in repair.ACCEPTED if q in best) == repair.search(rows)


def frame(spark, turns):
    return spark.createDataFrame([(*t, 1, 2, "x") for t in turns], SCHEMA)


def compare(got, want):
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got.collect()}
    assert got == want


@pytest.fixture(scope="module")
def turns():
    r = random.Random(5)
    words = ["Yes.", "No!", "Why?", "and then", "  ", "", "a\nb.", "a\nb", None, "same. \n", "é."]
    out = [(c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]), r.choice(words))
           for c in range(120) for t in range(r.randint(1, 9))]
    out += [(500, t, "ua"[t % 2] and ("user", "assistant")[t % 2], f"turn {t}" + "." * (t % 7 > 0)) for t in range(1500)]         # one long conversation
    out += [(501, 3, "user", "same.")] * 700 + [(None, 1, "user", "null id."), (None, None, "system", "no turn.")]
    out += [(502, 1, "user", "x" * 200_000 + "."), (502, 2, "assistant", "ok."), (502, 2, "assistant", "ok.")]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("n", [256, 5])
def test_repair_equals_plain(spark, turns, n):
    compare(repair.repair(frame(spark, turns), segment_rows=n), plain(turns, False))


def test_damaged_conversations_equal_plain(spark, turns):
    compare(repair.repair(repair.damage(frame(spark, turns))), plain(turns, True))


def test_repaired_rows_have_the_digest_of_the_report(spark, turns):
    some = [t for t in turns if t[0] in (1, 2, 3, 500, None)]
    plan = repair.repair(frame(spark, some))
    rows = {}
    for r in repair.repaired_rows(frame(spark, some), plan).collect():
        rows.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for r in plan.collect():
        lines = "\n".join(f"{role}:{text}" for _, role, text in sorted(rows.get(r.conv_id, [])))
        assert hashlib.sha256(lines.encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark):
    assert repair.repair(repair.damage(frame(spark, []))).count() == 0


def test_whole_table_equals_plain(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(queries.op13_repair(spark, d), plain(rows, True))


def test_no_nested_loop_and_no_python_before_the_range(spark, turns):
    plan = repair.faults(frame(spark, turns))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Python" not in plan and "MapInArrow" not in plan
