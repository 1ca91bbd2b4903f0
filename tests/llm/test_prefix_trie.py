import hashlib
import random
import zlib

from ratewright.llm import prefix_trie as M

SCHEMA = "conv_id long, turn int, role string, text string, words string, depth int"


def rebuilt(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    children = dict.fromkeys(members, 0)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, held in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(held) - 1) * (len(path[-1][1].split(" ")) - path[-1][1].split(" ").count("")) if path else 0
            leaves[path[:d]] += not children[path]
    out = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(path))
        out.append((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collect(spark, rows, heads=True, **bounds):
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA)
    convs = M.conversations(df)
    found = M.trie(M.with_shared_heads(convs) if heads else convs, **bounds)
    return sorted((tuple(r) for r in found.collect()), key=str)


def conversations(seed):
    pick = random.Random(seed)
    rows = []
    for c in range(-30, 130):
        own = [f"t{pick.randint(0, 2)} " + "word " * pick.randint(0, 3) for _ in range(pick.randint(1, 6))]
        rows += [(c, t, ["user", "assistant", None][t % 3], x) for t, x in enumerate(own)]
    # Equal long conversations, long ones that differ late, one that ends on their way.
    for c in range(400, 440):
        rows += [(c, t, "user", f"long {t}") for t in range(35)]
    for c in range(440, 470):
        rows += [(c, t, "user", f"long {t}" if t < 30 else f"other {c % 7}") for t in range(33)]
    rows += [(500, t, "user", f"long {t}") for t in range(12)] + [(501, 0, "user", None), (502, None, None, None), (503, 1, "ab", "c"), (504, 1, "a", "bc")]
    # Repeated turns, null turns first, no id.
    rows += [(505, 1, "user", "again"), (505, 1, "user", "again"), (505, None, "user", "first"), (None, 1, "user", "x"), (None, 2, "user", "x")]
    pick.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = conversations(1)
    wanted = brute(rebuilt(rows))
    assert len(wanted) > 300
    for bounds in ({}, {"most": 2, "turns": 5}, {"most": 10}, {"turns": 60}, {"most": 1, "turns": 1}):
        assert collect(spark, rows, **bounds) == wanted, bounds


def test_members_in_pieces(spark, monkeypatch):
    """A sequence with very many members is hashed in pieces, over several tasks."""
    rows = [(c, 0, "user", "one two three") for c in range(0, 3000)] + [(c, 1, "user", "x y") for c in range(0, 3000, 2)]
    convs = {c: [("user", "one two three")] + ([("user", "x y")] if c % 2 == 0 else []) for c in range(3000)}
    monkeypatch.setattr(M, "PIECE", 100)
    assert collect(spark, rows, heads=False) == brute(convs)


def test_turnless_and_empty(spark):
    assert collect(spark, []) == []
    # Conversation 21's one turn is replaced by those of a conversation that is not there.
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    assert collect(spark, [(lone, 0, "user", "x")]) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
