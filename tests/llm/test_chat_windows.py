"""Chat windows: exact round trip, masks, budgets, and cuts against a plain greedy loop."""

import hashlib
import random

import pytest

from lexigrain.llm import chat_windows
from lexigrain.llm.queries import registry

SCHEMA = "conv_id long, turn long, role string, text string, windows string, part string, name string"
ROLES = ["user", "assistant", "system", "tool", "", None, "<s>\nassistant"]
PIECES = ["<", "s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "\\", "\n", " ", "word", "Ünïcode ", "<</ROLE>>"]


def texts(draw, most=9):
    return draw.choice([None, "", "x " * draw.randint(0, 200), "".join(draw.choices(PIECES, k=draw.randint(0, most)))])


def conversation_rows(seed=1, convs=40, most=30):
    draw = random.Random(seed)
    rows = []
    for conv_id in [None, *range(convs)]:
        for turn in range(draw.randint(1, most)):
            role = "system" if turn == 0 and draw.random() < 0.5 else draw.choice(ROLES)
            rows.append((conv_id, None if turn == 0 and draw.random() < 0.3 else turn, role, texts(draw), "a", "b", "c"))
    rows += [rows[5], rows[9], (7, 3, "assistant", "tie", "a", "b", "c")]
    rows += [(500, turn, draw.choice(["user", "assistant"]), "very long " * 30_000, "a", "b", "c") for turn in range(3)]
    return rows


def ordered_turns(spark, frame):
    """Turns of each conversation in the stated order, by Spark's own hash."""
    found = {}
    rows = frame.selectExpr(
        "conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h"
    ).collect()
    for row in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.role.encode(), r.h)):
        found.setdefault(row.conv_id, []).append((row.role, row.text))
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(turns):
    out = {}
    for conv_id, found in turns.items():
        loss = "".join(text for role, text in found if role == "assistant")
        out[conv_id] = (len(found), sha("".join(f"{role}\n{text}\n" for role, text in found)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("settings", [
    {},
    {"budget": 64, "history": 16},
    {"budget": 64, "history": 40, "part_bytes": 700, "reach_bytes": 300},
    {"budget": 8, "history": 0, "part_bytes": 1, "reach_bytes": 0},
])
def test_windows_give_the_turns_back(spark, tmp_path, settings):
    frame = spark.createDataFrame(conversation_rows(), SCHEMA)
    turns = ordered_turns(spark, frame)
    path = str(tmp_path / "windows")
    found = chat_windows.window_digests(frame, path, **settings)
    assert {row.conv_id: tuple(row)[1:5] for row in found.collect()} == plain_digests(turns)
    rows = chat_windows.read_windows(spark, path).collect()
    assert sum(len(w.text) for row in rows for w in row.windows) == sum(row.formatted_chars for row in found.collect())
    budget = settings.get("budget", chat_windows.BUDGET)
    for row in rows:
        first_role = turns[row.conv_id][0][0]
        for at, window in enumerate(row.windows):
            shown = list(chat_windows.parsed(window.text))
            new = len(shown) - window.repeated
            assert new >= 1 and (window.tokens <= budget or new == 1)
            for span in window.loss:
                assert not any(mark in window.text[span.start : span.stop] for mark in chat_windows.CONTROL)
            if (row.part or at) and first_role == "system":
                assert shown[0] == turns[row.conv_id][0]
    assert len(rows) == len({(row.conv_id, row.part) for row in rows})
    if "part_bytes" in settings:
        assert any(row.part for row in rows) and any(row.windows[0].repeated > 1 for row in rows if row.part) == (settings["history"] > 0)


def greedy(costs, copies, system, first_is_system, budget, history):
    """The same cuts, turn by turn."""
    out, first = [], copies
    while first < len(costs):
        room = budget - 1 - (0 if first_is_system and first == 0 else system)
        back, held = first, 0
        while back > (1 if first_is_system and first else 0) and held + costs[back - 1] <= min(history, room - costs[first]):
            back -= 1
            held += costs[back]
        end, used = first + 1, held + costs[first]
        while end < len(costs) and used + costs[end] <= room:
            used += costs[end]
            end += 1
        out.append((back, first, end))
        first = end
    return out


def test_cuts_equal_a_greedy_loop():
    draw = random.Random(8)
    for _ in range(4000):
        costs = [draw.randint(1, 30) for _ in range(draw.randint(1, 25))]
        copies = draw.choice([0, 0, draw.randrange(len(costs))])
        first_is_system = copies == 0 and draw.random() < 0.5
        system = costs[0] if first_is_system else draw.choice([0, 5, 50])
        case = (costs, copies, system, first_is_system, draw.choice([10, 40, 90]), draw.choice([0, 12, 35]))
        assert chat_windows.spans(*case) == greedy(*case), case


def test_template_is_reversible():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choices([*"<>[]/s\\\n ", *PIECES], k=draw.randint(0, 12)))
        escaped = chat_windows.escape(text)
        assert chat_windows.unescape(escaped) == text
        assert not any(mark in escaped for mark in chat_windows.CONTROL)
        shown = [(draw.choice(ROLES) or "", text), ("assistant", text), ("user", text)]
        window = chat_windows.BEGIN + "".join(chat_windows.rendered(*turn)[0] for turn in shown)
        assert list(chat_windows.parsed(window)) == shown


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat_windows.window_digests(frame, str(tmp_path / "none")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    found = {row.conv_id: tuple(row)[1:5] for row in registry()["op12_chat_windows"](spark, folder).collect()}
    turns = ordered_turns(spark, spark.read.parquet(f"{folder}/conversations.parquet"))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert found == plain_digests(turns)
