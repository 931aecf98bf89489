import random

from brandtrack.llm import chat_format as cf


def show(turns):
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for _, role, text in turns)


def spans(turns):
    found, at = [], 0
    for _, role, text in turns:
        start = at + len("<|im_start|>") + len(role) + 1
        at += len(show([(0, role, text)]))
        if role == "assistant":
            found.append((start, at))
    return found


def plain(rows):
    """Pairs from rows ``(conv_id, turn, role, text)``."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None and turn is not None:
            convs.setdefault(conv, set()).add((turn, role or "", text or ""))
    found = set()
    for pair in {c // 2 for c in convs}:
        a, b = (convs.get(2 * pair + k, set()) for k in (0, 1))
        first = min((t for t, _, _ in a ^ b), default=None)
        shared = lambda t: first is None or t[0] < first
        here = [sorted(side) for side in (a, b)]
        prompt = [t for t in here[0] if shared(t)]
        chosen, rejected = ([t for t in side if not shared(t)] for side in here)
        ids = tuple(2 * pair + k if 2 * pair + k in convs else None for k in (0, 1))
        found.add(
            (pair, *ids, len(prompt), show(prompt), show(chosen), show(rejected))
            + tuple(",".join(f"{s}:{e}" for s, e in spans(x)) for x in (chosen, rejected))
        )
    return found


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        if rng.random() < 0.1:
            continue
        n = rng.choice([1, 2, 4, 7, 600 if conv % 20 == 0 else 3])
        same = rng.randrange(n + 1)
        for turn in range(n):
            if rng.random() < 0.05:
                continue
            text = f"é{turn}" if turn < same else rng.choice([None, "", f"own {conv}\n{turn} 🙂"])
            rows.append((conv, turn, rng.choice(["user", None]) if turn % 2 == 0 else "assistant", text))
            if rng.random() < 0.1:
                rows.append(rng.choice([rows[-1], (conv, turn, "assistant", "second")]))
    rows += [(None, 1, "user", "x"), (3, None, "user", "x"), (-1, 0, "user", "minus"), (-2, 0, "user", "minus")]
    rng.shuffle(rows)
    return rows


def test_pairs_equal_plain_code(spark):
    for seed in range(3):
        rows = conversations(seed)
        frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, prompt string")
        got = cf.digest(frame).repartition(3).collect()
        assert {tuple(r) for r in got} == plain(rows) and len(got) == len(plain(rows))


def test_masks_cut_what_the_assistant_says(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "yes"), (0, 2, "user", "r"), (0, 3, "assistant", "ö!")]
    rows += [(1, 0, "user", "q"), (1, 1, "assistant", "no")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = cf.format_pairs(cf.sides(frame)).collect()
    assert row["prompt"] == "<|im_start|>user\nq<|im_end|>\n"
    assert [row["chosen"][s["start"] : s["end"]] for s in row["chosen_mask"]] == ["yes<|im_end|>\n", "ö!<|im_end|>\n"]
    assert [row["rejected"][s["start"] : s["end"]] for s in row["rejected_mask"]] == ["no<|im_end|>\n"]


def test_a_long_pair_is_one_row(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{t}" if t < 400 else f"{c}-{t}") for c in (0, 1) for t in range(600)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = cf.format_pairs(cf.sides(frame)).collect()
    assert row["n_prompt_turns"] == 400 and len(row["chosen_mask"]) == 100
    assert [row["rejected"][s["start"] : s["end"]] for s in row["rejected_mask"]][-1] == "1-599<|im_end|>\n"


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.digest(frame).collect() == []
