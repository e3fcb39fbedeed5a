import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from reelmart.llm import repair as R

PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\f\r"


def _edits(codes):
    """All edit strings with at most two insertions in a row: (cost, edits, initials)."""
    gaps = ["", "I", "II"]
    for before in itertools.product(gaps, repeat=len(codes) + 1):
        for rows in itertools.product("DKR", repeat=len(codes)):
            edits = before[0] + "".join(r + g for r, g in zip(rows, before[1:]))
            if all(not (c >> 2 in (1, 2) and r != "D") for c, r in zip(codes, rows)):
                yield edits


def _cost(codes, edits):
    """Least cost over the roles that insertions and reroles may give; None where none fits the pattern."""
    parts, cost, i = [], 0, 0
    for e in edits:
        if e == "I":
            parts.append("ua")
            cost += 5
            continue
        c = codes[i]
        i += 1
        if e == "D":
            cost += 2
            continue
        cost += (e == "R") + (5 if c >> 2 == 3 else 0)
        parts.append("sua?"[c & 3] if e == "K" else "ua")
    return cost if any(PATTERN.fullmatch("".join(p)) for p in itertools.product(*parts)) else None


def test_cheapest_edits_equal_brute_force():
    r = random.Random(5)
    cases = [[], [0], [0, 0], [2], [2, 1], [13, 2], [1, 14, 1], [3, 3]] + [[r.randrange(16) for _ in range(r.randrange(1, 5))] for _ in range(60)]
    for codes in cases:
        want = min((cost, e) for e in _edits(codes) if (cost := _cost(codes, e)) is not None)
        assert R.cheapest_edits(bytes(codes)) == want, codes


def _plain(codes):
    """Backward recursion with whole strings."""
    v = {0: (0, ""), 3: (0, ""), 2: (5, "I"), 1: (10, "II")}
    for c in reversed(codes):
        w = {q: min((cost + v[to][0], e + v[to][1]) for e, cost, to in R._moves(c, q)) for q in range(4)}
        for _ in range(3):
            w = {q: min(w[q], (5 + w[R._INSERTED[q]][0], "I" + w[R._INSERTED[q]][1])) for q in range(4)}
        v = w
    return v[0]


def test_checkpointed_walk_equals_the_plain_recursion():
    r = random.Random(6)
    for n in (1, 2, 3, 15, 16, 17, 99, 400):
        codes = bytes(r.choice([1, 2, 1, 2, 13, 14, 0, 3, 5, 10]) for _ in range(n))
        assert R.cheapest_edits(codes) == _plain(codes)


def _brute(rows):
    """Reports of (conv_id, turn, role, text) rows after the contract's damage, in plain Python."""
    one = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in rows:
        here = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if kind == 0:
            continue
        role, text = one(role) if kind != 4 else "user", one(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here.extend([(turn, role, text)] * (2 if kind == 3 else 1))
    out = {}
    for conv, here in convs.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes = set(), []
        for _, role, text in here:
            bare = text.rstrip(SPACE)
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append("sua".find(role[:1] or "?") % 4 + 4 * fault)
        cost, audit = _plain(codes)
        turns = [t for t, _, _ in here if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:]))
        fixed, last, at = [], "", 0
        for e in audit:
            row = here[at] if e != "I" else None
            at += e != "I"
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            fixed.append(f"{role}:{row[2] if row else ''}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(c >> 2 == f for c in codes) for f in (1, 2, 3)],
                     illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def _reports(df):
    return {r.conv_id: tuple(r[c] for c in (*R.REPORT, "audit", "repaired_sha256")) for r in df.collect()}


def _rows():
    r = random.Random(7)
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, None, None), (3, 0, "assistant", "a."), (None, 0, "user", "x."), (None, 1, None, "y."),
            (4, 0, "", "no role."), (4, 1, "tool", "z."), (5, 7, "user", " \t\n"), (6, 1, "user", "same."), (6, 1, "user", "same."), (6, 2, "assistant", "b. \n")]
    for conv in range(10, 60):
        for turn in range(r.randrange(1, 12)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", None, "bot"])
            rows.append((conv, r.choice([turn, turn, turn, None, turn * 2]), role, r.choice(["One.", "two", "Three!", "é漢?", "", None, "x" * 50 + "."])))
    rows += [(99, i, "user" if i % 2 == 0 else "assistant", f"line {i}." if i % 3 else "again.") for i in range(3000)]  # one long conversation
    return rows


def test_query_equals_brute_force_with_nulls_ties_and_a_long_conversation(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    assert _reports(R.op11_repair(spark, str(tmp_path))) == _brute(rows)


def test_repaired_rows_and_clashing_columns(spark, clashing):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "cut"), (1, 3, "assistant", "Done.")]
    df = clashing(spark.createDataFrame(rows, SCHEMA)).withColumns({c: F.lit("mine") for c in ("tie", "there", "digest", "part", "code", "position", "edit")})
    got = R.repair(df).orderBy("position").collect()
    assert (got[0].cost, got[0].audit, got[0].truncated) == (4, "DKDK", 1)
    assert [(r.edit, r.role, r.text) for r in got[1:]] == [("K", "user", "Again."), ("K", "assistant", "Done.")]


def test_empty_table_and_conversations_without_rows(spark):
    assert R.digests(R.repair(spark.createDataFrame([], SCHEMA))).collect() == []
    gone = spark.createDataFrame([(5, 0, "user", "x.", False), (5, 1, "user", "x.", None)], SCHEMA + ", present boolean")
    assert _reports(R.digests(R.repair(gone, present="present"))) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
