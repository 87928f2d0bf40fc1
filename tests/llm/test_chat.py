import hashlib
import random

import pytest

from subtally.llm import chat

MARKS = [chat.BEGIN, chat.END, chat.OPEN, chat.CLOSE, "\\", "<", "[", "/s>", "INST]", "a", " ", "\n", "é", "😀", "$1"]
REPLY = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def tricky(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, 12))) for _ in range(count)]


def test_escapes_are_reversible_and_leave_no_mark(spark):
    rows = [(x,) for x in {"", *MARKS, *tricky(1, 3000)}]
    frame = spark.createDataFrame(rows, "x string").selectExpr("x", f"{chat.escaped('x')} AS y")
    for r in frame.selectExpr("x", "y", f"{chat.unescaped('y')} AS z").collect():
        assert r.z == r.x
        assert not any(mark in r.y for mark in MARKS[:4])


def expected(turns):
    """(n_turns, turns digest, loss text, formatted characters) by plain Python."""
    escape = [("\\", "\\\\"), *((m, f"{m[0]}\\{m[1:]}") for m in MARKS[:4])]

    def size(text):
        for a, b in escape:
            text = text.replace(a, b)
        return len(text)

    listed = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(listed.encode()).hexdigest(), loss, 3 + sum(17 + size(r) + size(t) for r, t in turns)


def test_conversations_read_back_as_they_were(spark):
    roles = ["user", "assistant", "system", None, "[INST]"]
    rows, turns = [], {}
    for conv in [*range(40), None]:
        texts = tricky(conv or 99, (conv or 7) % 9 + 1)
        for i, text in enumerate(texts):
            role = roles[(i + (conv or 0)) % 5]
            rows.append((conv, i, role, text if i != 3 else None, "extra"))
            turns.setdefault(conv, []).append((role or "", text if i != 3 else ""))
    rows += [(500, 1, "user", "same", ""), (500, 1, "user", "same", ""), (500, 1, "assistant", "x" * 200_000, ""), (500, None, "user", "", "")]
    turns[500] = [("assistant", "x" * 200_000), ("user", "same"), ("user", "same"), ("user", "")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, node string").repartition(5)
    found = chat.read_back(chat.format_replies(chat.as_replies(frame)))
    got = {r.tree: r for r in found.select("tree", "loss_text", *chat.digest_columns(found)).collect()}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        r, (n, digest, loss, size) = got[conv], expected(own)
        assert (r.n_turns, r.turns_sha256, r.loss_text, r.loss_chars, r.formatted_chars) == (n, digest, loss, len(loss), size)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def brute_paths(rows, keep):
    """The best paths of each tree by walking up from every leaf."""
    found = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in own.values()}
        leaves = []
        for node in own:
            path, at, seen = [], node, set()
            while at in own and at not in seen:
                seen.add(at)
                path.append(own[at])
                at = own[at][2]
            if node not in parents and at not in seen:
                leaves.append((-sum(r[5] for r in path), node, [(r[3], r[4]) for r in reversed(path)]))
        for branch, (_, _, path) in enumerate(sorted(leaves)[:keep], 1):
            found[tree, branch] = path
    return found


@pytest.mark.parametrize("keep", [1, 3])
def test_paths_are_those_of_a_walk(spark, keep):
    rng = random.Random(keep)
    rows = []
    for tree in range(12):
        for node in range(rng.randint(1, 60)):
            parent = rng.choice([None, rng.randrange(node)]) if node and rng.random() < 0.2 else (node - 1 if node else None)
            parent = 10_000 + node if rng.random() < 0.03 else parent  # replies to what isn't there
            rows.append((tree, node, parent, "user", f"{tree}/{node}", float(rng.randint(-2, 2))))
    rows += [(50, 1, 2, "user", "c1", 1.0), (50, 2, 1, "user", "c2", 1.0), (50, 3, 2, "user", "below", 9.0), (50, 9, None, "user", "alone", 0.0)]
    rows += [(51, 1, 1, "user", "its own parent", 1.0)]
    found = {}
    for r in chat.paths(spark.createDataFrame(rows, REPLY).repartition(4), keep).collect():
        found.setdefault((r.tree, r.branch), []).append((r.place, r.role, r.text))
    assert {k: [x[1:] for x in sorted(v)] for k, v in found.items()} == brute_paths(rows, keep)


def test_odd_messages(spark):
    rows = [
        (1, 1, None, "user", "root", None),
        (1, 1, None, "user", "root", None),  # repeated
        (1, 2, 1, None, None, float("nan")),
        (1, None, 1, "user", "no id", 5.0),
        (None, 7, None, "assistant", "null tree", 1.0),
    ]
    found = chat.format_replies(spark.createDataFrame(rows, REPLY))
    assert {(r.tree, r.branch): r.formatted for r in found.collect()} == {
        (1, 1): "<s>[INST]user[/INST]root</s>[INST][/INST]</s>",
        (None, 1): "<s>[INST]assistant[/INST]null tree</s>",
    }
    assert [[tuple(s) for s in r.loss] for r in found.orderBy("tree").collect()] == [[(25, 34)], []]


def test_no_messages(spark):
    assert chat.read_back(chat.format_replies(spark.createDataFrame([], REPLY))).count() == 0
