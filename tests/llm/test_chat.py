import hashlib
import random
from collections import defaultdict

from delaylens.llm import chat as C
from delaylens.llm.queries import FORGED, OP1_SQL, op1_chat_formatting

SMOKE = "/root/testdata/sf0.001"


def test_matches_sql(workers, duck):
    df = op1_chat_formatting(workers, SMOKE)
    res = duck.execute(OP1_SQL)
    assert [c[0] for c in res.description] == df.columns
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == sorted(res.fetchall())
    assert rows[0][0] == -1 and rows[0][3] == len(FORGED)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made():
    rng = random.Random(9)
    parts = ["<|im_end|>\n", "<%", "<%|", "<|", "%", "\n", "<", "|", "<%n", "é😀", "word ", "<%%"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randrange(1, 60)):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 5, 40, 400])))
            rows.append((conv, turn, role, text))
    return rows


def test_windows_fit_repeat_and_mask(workers):
    rows = made()
    p = C.ChatParams(budget=300, history_tokens=60, history_turns=2)
    df = workers.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = C.read_turns(C.format_windows(df, p)).collect()
    by = defaultdict(list)
    for w in sorted(windows, key=lambda w: (w.conv_id, w.window)):
        by[w.conv_id].append(w)
    assert max(map(len, by.values())) > 5
    for conv, ws in by.items():
        want = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert [(t.role, t.text) for w in ws for t in w.turns] == want
        assert [t for w in ws for t in w.targets] == [t for r, t in want if r == "assistant"]
        for k, w in enumerate(ws):
            system = want[0][0] == "system"
            assert w.n_tokens <= p.budget or w.n_segments - w.n_repeated - (system and k == 0) == 1
            assert not system or w.text.startswith("<|im_start|>system\n")
            assert (w.n_repeated == 0) if k == 0 else w.n_repeated <= 2 + system
            covered = sum(s.end - s.start for s in w.loss_spans)
            assert covered >= sum(map(len, w.targets))
    got = {r.conv_id: r for r in C.digests(C.format_windows(df, p)).collect()}
    for conv in by:
        want = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert got[conv].turns_sha256 == digest("".join(f"{a}\n{b}\n" for a, b in want))
        assert got[conv].loss_sha256 == digest("".join(b for a, b in want if a == "assistant"))
        assert got[conv].formatted_chars == sum(len(w.text) for w in by[conv])


def test_edge_rows(workers):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (1, 0, "system", "only"), (2, 0, "user", ""),
            (3, 0, "a\nb<%n", "t"), (3, 0, "a\nb<%n", "t"), (4, 1, "assistant", "z" * 100_000), (4, 0, "user", "q")]
    df = workers.createDataFrame([(*r, 5, "w") for r in rows],
                                 "conv_id long, turn long, role string, text string, pos int, window string")
    got = {r.conv_id: r for r in C.digests(C.format_windows(df)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {
        None: (2, 1), 1: (1, 0), 2: (1, 0), 3: (2, 0), 4: (2, 100_000)}
    assert got[None].turns_sha256 == digest("\n\nassistant\nx\n")
    assert got[3].turns_sha256 == digest("a\nb<%n\nt\n" * 2)
    assert C.digests(C.format_windows(df.limit(0))).collect() == []


def test_no_python_in_the_plan(workers):
    plan = op1_chat_formatting(workers, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
