import hashlib

from ratewright.llm import chat, queries

HARD = [
    "", "plain", "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\|x", "<", "ends with <", "<<|", "<|<|", "<\\<|\\|",
    "$1 \\1 \\", "<|nl|>", "\n\n", "日本 <|endoftext|> 🎈", "a<\\", "|", "<\\|", None,
]


def parse(formatted):
    """The grammar by hand."""
    turns, spans, at = [], [], 0
    undo = lambda s: "".join(_undo(s))

    def _undo(s):
        k = 0
        while k < len(s):
            yield s[k]
            if s[k] == "<":
                e = k + 1
                while e < len(s) and s[e] == "\\":
                    e += 1
                if e > k + 1 and e < len(s) and s[e] == "|":
                    k += 1
            k += 1

    while at < len(formatted):
        assert formatted.startswith("<|im_start|>", at)
        line = formatted.index("\n", at)
        end = formatted.index("<|", line)
        assert formatted.startswith("<|im_end|>\n", end)
        turns.append((undo(formatted[at + 12 : line].replace("<|nl|>", "\n")), undo(formatted[line + 1 : end])))
        spans.append((line + 1, end - line - 1))
        at = end + 11
    return turns, spans


def test_round_trip(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], s, 0) for t, s in enumerate(HARD)]
    rows += [(2, t, "assistant", s, 0) for t, s in enumerate(HARD)]
    rows += [(3, 0, "odd\nrole<|", "x", 0), (3, 0, None, None, 0), (3, None, "user", "first", 0), (None, 1, "user", "null id", 0)]
    rows += [(4, 1, "user", "same", 0), (4, 1, "user", "same", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start int")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in formatted.collect()}
    digests = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, row in got.items():
        wanted = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        turns, spans = parse(row.formatted)
        assert turns == wanted and row.round_trip
        loss = [(n, *spans[n]) for n, (role, _) in enumerate(turns) if role == "assistant"]
        assert [tuple(s) for s in row.loss] == loss
        said = "".join(t for role, t in wanted if role == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(wanted), len(said), len(row.formatted))
        assert d.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in wanted).encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_no_python_in_plan(spark, small):
    plan = queries.op4_format_chats(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
