import hashlib
import random

from rowmill.llm import chat

from helpers import save

PIECES = ["\\", "#", "##", "###", "</turn>", "<", "/turn>", " ", "\n", "a", "b", "é", "### Assistant: ", ":", "😀"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def turns_of(rng, most=6):
    return [(rng.choice(["user", "assistant", "system", "", "x:y", "=", "\\", "User"]), "".join(rng.choice(PIECES) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(most))]


def test_round_trip_and_spans():
    rng = random.Random(1)
    for _ in range(1500):
        turns = turns_of(rng)
        shown, spans, rewriting = chat.locate(turns, chat.marked)
        assert rewriting == -1 and chat.read_back(shown) == turns
        assert [chat.unescape(shown[a:b]) for _, a, b, _ in spans] == [t for _, t in turns]
        assert [s[0] for s in spans[1:]] + [len(shown)] == [s[3] for s in spans] or not turns


def test_rewriting_templates_are_found():
    turns = [("user", "q"), ("assistant", "a"), ("user", "z")]

    def forgets(given):
        return "".join(f"{r}:{t if i == len(given) - 1 else '-'};" for i, (r, t) in enumerate(given))

    assert chat.locate(turns, forgets)[2] == 1
    assert chat.locate(turns, lambda given: f"{len(given)} turns;" + chat.marked(given))[2] == 0
    assert chat.locate(turns, lambda given: "<s>" + chat.marked(given))[2] == -1


def test_op2_matches_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = []
    for c in [*range(30), None]:
        for k, (role, text) in enumerate(turns_of(rng, 200 if c == 3 else 8)):
            rows.append((c, k, role or None, text or None))
    rows += [(40, 1, "user", "same")] * 3 + [(40, None, "assistant", "first"), (41, 5, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as slice", "2 as part", "3 as formatted").repartition(3)
    save(df, tmp_path, "conversations")
    got = {r.conv_id: r for r in chat.formatted_conversations(spark, str(tmp_path)).collect()}
    want = {}
    for c, k, role, text in sorted([*rows, (-7, 0, "user", chat.TRICKY), (-7, 1, "assistant", chat.TRICKY)], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        all_ = "".join(f"{r}\n{t}\n" for r, t in turns)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest(all_), len(loss), digest(loss))
        assert r.formatted_chars == len(chat.marked(turns)) and not r.rewrites


def test_slices_show_a_template_that_looks_back(spark, monkeypatch):
    df = spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(3)] + [(2, 0, "user", "alone")], SCHEMA)

    def joined(given):
        return "|".join(t for _, t in given)

    rows = {r.conv_id: r.rewrites for r in chat.format_conversations(df, joined).collect()}
    assert rows == {1: False, 2: False}  # appends only
    rows = {r.conv_id: r.rewrites for r in chat.format_conversations(df, lambda g: str(len(g)) + joined(g)).collect()}
    assert rows == {1: True, 2: True}


def test_templates_that_look_back_over_slices(spark):
    def joining(given):
        return "|".join(t for _, t in given)

    def shortening(given):
        return "".join(f"{t if len(given) <= 70 or k > len(given) - 70 else t[:1]};" for k, (_, t) in enumerate(given))

    df = spark.createDataFrame([(c, k * (1 + 99 * (c == 3)), "user", f"t{k}") for c, n in [(1, 200), (2, 60), (3, 10)] for k in range(n)], SCHEMA)
    turns = {c: [("user", f"t{k}") for k in range(n)] for c, n in [(1, 200), (2, 60), (3, 10)]}
    for template, rewriting in ((joining, set()), (shortening, {1})):
        rows = chat.format_conversations(df, template).collect()
        assert {r.conv_id: r.formatted for r in rows} == {c: template(t) for c, t in turns.items()} and len(rows) == 3
        assert {r.conv_id for r in rows if r.rewrites} == rewriting
    for template in (joining, lambda g: "<s>" + chat.marked(g)):
        rows = sorted(chat.format_conversations(df, template, whole=False).collect())
        assert [r.rewrites for r in rows if r.conv_id == 1] == [False, True, True, True]
        assert [r.rewrites for r in rows if r.conv_id == 2] == [False]
        assert [r.rewrites for r in rows if r.conv_id == 3] == [False] + [True] * 9
    rows = sorted(chat.format_conversations(df).collect())
    assert len(rows) == 15 and not any(r.rewrites for r in rows)
    assert "".join(r.formatted for r in rows if r.conv_id == 1) == chat.marked(turns[1])


def test_empty_table(spark, tmp_path):
    save(spark.createDataFrame([], SCHEMA), tmp_path, "conversations")
    rows = chat.formatted_conversations(spark, str(tmp_path)).collect()
    assert [r.conv_id for r in rows] == [-7] and rows[0].loss_chars == len(chat.TRICKY)
