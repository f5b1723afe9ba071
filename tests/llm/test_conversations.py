import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import conversations as c
from millrace.llm.queries import LLM_QUERIES
from tests.conftest import rows
from tests.llm.helpers import SF_DIR

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def damage(turns):
    out = []
    for conv, turn, role, text in turns:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def order(turn):
    _, number, role, text = turn
    return number is not None, number or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def targets(n):
    for length in range(0, 2 * n + 4):
        pairs = "ua" * (length // 2)
        if length % 2 == 0:
            yield pairs
        elif length > 1:
            yield "s" + pairs


def cheapest(turns, forced, broken):
    """(cost, letters, repaired turns) by aligning the turns with every legal sequence of roles."""
    best = None
    for target in targets(len(turns)):
        at = {}
        for i in range(len(turns), -1, -1):
            for j in range(len(target), -1, -1):
                found = [(0, "", ())] if i == len(turns) and j == len(target) else []
                name = {"u": "user", "a": "assistant"}.get(target[j : j + 1])
                if i < len(turns):
                    cost, letters, rest = at[i + 1, j]
                    found.append((cost + 3, "D" + letters, rest))
                if j < len(target) and name:
                    cost, letters, rest = at[i, j + 1]
                    found.append((cost + 2, "I" + letters, ((name, ""), *rest)))
                if i < len(turns) and j < len(target) and not forced[i]:
                    cost, letters, rest = at[i + 1, j + 1]
                    _, _, role, text = turns[i]
                    if role[:1] == target[j]:
                        found.append((cost + broken[i], "K" + letters, ((role, text), *rest)))
                    if name:
                        found.append((cost + 2 + broken[i], "R" + letters, ((name, text), *rest)))
                if found:
                    at[i, j] = min(found)
                else:
                    at[i, j] = (10**9, "", ())
        best = min(best or at[0, 0], at[0, 0])
    return best


def judged(turns):
    """The row of one conversation, all its turns after the damage given."""
    turns = sorted(turns, key=order)
    seen, faults = set(), []
    for _, _, role, text in turns:
        kind = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else ""
        faults.append(kind or ("truncated" if text.rstrip(WHITE)[-1] not in ".!?" else ""))
        seen.add((role, text))
    count, numbers = Counter(faults), {t[1] for t in turns if t[1] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    initials = [t[2][:1] for t in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, repaired = cheapest(turns, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def expected(turns):
    grouped = defaultdict(list, {t[0]: [] for t in turns})
    for t in damage(turns):
        grouped[t[0]].append(t)
    return sorted(((conv, *judged(some)) for conv, some in grouped.items()), key=repr)


def plain(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


def run(spark, frame, folder):
    frame.write.parquet(f"{folder}/conversations.parquet")
    return rows(LLM_QUERIES["op12_conversation_repair"].run(spark, str(folder)), *COLUMNS)


def test_as_by_brute_force(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    assert rows(LLM_QUERIES["op12_conversation_repair"].run(spark, SF_DIR), *COLUMNS) == expected(plain(turns))


def random_turns(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "u2", "User"]
    texts = ["A.", "B!", "C?", "D", "", " \n", None, "E.  \t", "F..", "ä", "G \x0b.\x0b"]
    out = []
    for conv in range(convs):
        for _ in range(rng.randint(0, most)):
            text = rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}{rng.choice(['.', '!', ''])}"
            out.append((rng.choice([conv, conv, conv, None]) if conv == 3 else conv, rng.choice([None, *range(9)]), rng.choice(roles), text))
    return out


def test_odd_conversations_clashing_columns_and_empty_table(spark, tmp_path):
    turns = random_turns(1, 150, 7)
    frame = spark.createDataFrame(turns, SCHEMA).repartition(3)
    more = frame.withColumns({n: F.lit("x") for n in ("conv", "at", "code", "same", "audit")})
    assert run(spark, more, tmp_path / "a") == expected(turns)
    assert run(spark, frame.limit(0), tmp_path / "b") == []


@pytest.mark.parametrize("chunk_rows", [1, 2, 3])
def test_chunks_give_what_whole_conversations_give(spark, chunk_rows):
    """Every conversation is cut, so vectors, states, repeats, gaps and jumps all cross borders."""
    turns = damage(random_turns(2, 60, 9))
    alone = [t for t in turns if t[0] is not None]
    repair = c.Repair(spark.createDataFrame(alone, SCHEMA), chunk_rows=chunk_rows)
    report = {r.conv: r for r in repair.report.collect()}
    digests = {r.conv: r.digest for r in repair.text_digests().collect()}
    grouped = defaultdict(list)
    for t in alone:
        grouped[t[0]].append(t)
    assert set(grouped) == set(report) == set(digests)
    for conv, some in grouped.items():
        r = report[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[conv]) == judged(some)
    assert all(t.edit in "KRI" and (t.edit != "I" or t.text == "") for p in repair.pieces.collect() for t in p.turns)


def long_conversation(kind, n):
    say = {"pairs": ["user", "assistant"], "user": ["user"], "system": ["system"], "odd": ["user", "assistant", "tool", "user", "system"]}
    if kind == "same":
        return [(1, i, "user", "The same.") for i in range(n)]
    return [(1, i, say[kind][i % len(say[kind])], f"Turn {i}{'.' if i % 7 else ''}") for i in range(n)]


@pytest.mark.parametrize("kind", ["pairs", "user", "system", "odd", "same"])
def test_a_long_conversation_in_many_chunks(spark, kind):
    turns = long_conversation(kind, 60)
    repair = c.Repair(spark.createDataFrame(turns, SCHEMA).repartition(4), chunk_rows=8)
    (r,) = repair.report.collect()
    (digest,) = repair.text_digests().collect()
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest.digest) == judged(turns)


def test_reruns_stop_where_vectors_differ_by_a_constant():
    """In a chain of pairs the guess of the last turn's vector is forgotten at once."""
    codes = bytes([1, 2] * 50)
    out, total = c.run_back(codes, c.END)
    new = (1, 1, 0, 0)
    assert c.rerun_back(codes, c.END, new, out, total) == c.run_back(codes, new)
    c.back.cache_clear()
    c.rerun_back(codes, c.END, c.END, out, total)
    assert c.back.cache_info().misses == 0
