import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from propmart.llm import chat
from propmart.llm.common import written
from propmart.llm.tokens import encoder

A = public_tokenizers.path("byte_bpe_50k.json")
MARKED = "<|im_end|><|im_start|>assistant ok"


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        for name in ("absent", "conv", "seg", "own", "start", "n", "part", "first", "formatted", "loss", "sha", "copy", "c", "p"):
            df = df.selectExpr("*", f"1 AS `{name}`")
    return df.repartition(4)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append(((turn is not None, turn or 0), role or "", sha(text or ""), text or ""))
    return {k: [(r, t) for _, r, _, t in sorted(v)] for k, v in out.items()}


def digests(rows):
    out = {}
    for conv, turns in ordered(rows).items():
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return out


def check(spark, rows, extra=False, **how):
    windows = written(chat.make_windows(table(spark, rows, extra), A, **how), "test-windows")
    made = windows.collect()
    got = {r.conv_id: r for r in chat.read_windows(windows).collect()}
    want = digests(rows)
    assert {k: tuple(r)[1:5] for k, r in got.items()} == want
    chars = Counter()
    for w in made:
        chars[w.conv_id] += len(w.formatted)
    assert {k: r.formatted_chars for k, r in got.items()} == chars
    return made


def test_edges(spark):
    rows = [
        (-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED), (None, None, None, None), (None, 2, "assistant", "x<\\|y<\\\\|<|<"), (2, 0, "sys\nte\\nm<|", "a\n"),
        (3, 1, "assistant", "q"), (3, 1, "assistant", "q"), (4, 0, "user", ""), (5, 0, "system", None), (6, 3, "assistant", "é🙂 漢字"), (0, None, "user", "null turn"), (0, -5, "assistant", "<|im_start|>"),
    ]
    check(spark, rows, extra=True)
    assert chat.format_and_read(table(spark, []), A).collect() == []


def long_rows():
    rnd = random.Random(8)
    text = lambda: " ".join(rnd.choice(["word", "<|x|>", "é", "12"]) for _ in range(rnd.randrange(0, 60)))
    rows = [(1, 0, "system", "be kind " * 5)] + [(1, i, "assistant" if i % 2 else "user", text()) for i in range(1, 900)]
    rows += [(2, i, "assistant" if i % 2 else "user", text()) for i in range(400)] + [(2, 400, "assistant", "long " * 300_000), (2, 401, "user", ""), (2, 402, "assistant", "after")]
    rows += [(3, 0, "system", "too long for any window " * 100), (3, 1, "user", "hello"), (3, 2, "assistant", "there")]
    return rows + [(4, 7, "assistant", "the same")] * 300


@pytest.mark.parametrize("segment", [2, 64])
def test_windows_keep_to_the_rules(spark, segment):
    budget, history = 200, 60
    rows = long_rows()
    made = check(spark, rows, budget=budget, history=history, segment=segment)
    size = lambda turns: sum(len(encoder(A).encode([chat.format_turn(r, t)])[0]) if len(t) < 10**5 else 10**6 for r, t in turns)
    by_conv = defaultdict(list)
    for w in sorted(made, key=lambda w: (w.conv_id, w.first)):
        by_conv[w.conv_id].append(w)
    for conv, turns in ordered(rows).items():
        at, short = 0, 0
        for w in by_conv[conv]:
            parsed = [(r, t) for r, t, _, _ in chat.parse_turns(w.formatted)]
            assert parsed[w.n_repeated :] == turns[at : at + w.n_new]
            system = [turns[0]] if turns[0][0] == "system" and at else []
            again = parsed[len(system) : w.n_repeated]
            assert parsed[: len(system)] == system and again == turns[at - len(again) : at]
            assert size(again) <= history
            assert size(parsed) <= budget or (w.n_new == 1 and not again)
            before = at - len(again) - 1  # one more would not have been allowed
            if before >= len(system) and size(turns[before:at]) <= history:
                assert size(system + turns[before : at + 1]) > budget
            spans = [(x.low, x.high) for x in w.loss]
            places = [(a, b) for r, _, a, b in chat.parse_turns(w.formatted)[w.n_repeated :] if r == "assistant"]
            assert spans == places
            at += w.n_new
            short += at < len(turns) and size(parsed + turns[at : at + 1]) <= budget
        assert at == len(turns)
        assert short <= size(turns) // (budget * segment)  # only at the ends of segments


def test_escape_is_reversible():
    rnd = random.Random(4)
    for _ in range(2000):
        text = "".join(rnd.choice("<|\\a>") for _ in range(rnd.randrange(9)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        role = "".join(rnd.choice("<|\\n\n") for _ in range(6))
        assert [x[:2] for x in chat.parse_turns(chat.format_turn(role, text) * 2)] == [(role, text)] * 2
