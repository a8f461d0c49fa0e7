"""Small documents that hold every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, k_id long, found string"


def prose(rng: random.Random, n: int, letters: str = "abcdefgh") -> list[str]:
    return ["".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(n)]


def documents(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base, shared = prose(rng, 120), prose(rng, 26)
    texts = {i: " ".join(prose(rng, rng.randint(1, 90))) for i in range(1, 40)}
    for i in range(40, 70):   # near copies of one text, some beyond the threshold, in several cases and spacings
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = rng.choice(prose(rng, 3))
        texts[i] = "\n".join([" ".join(words[:60]).upper() if i % 7 == 0 else " ".join(words[:60]), "\t ".join(words[60:])])
    for i in range(70, 90):   # a passage that many share
        words = prose(rng, 40)
        at = rng.randrange(40)
        texts[i] = " ".join([*words[:at], *shared, *words[at:]])
    for i in range(90, 100):
        texts[i] = texts[41]
    texts |= {100: "", 101: None, 102: " \n\t ", 103: "one", 104: "ONE", 105: "a b c d e", 106: "x" * 30_000, 107: " ".join(["again"] * 400),
              108: " ".join(prose(rng, 30_000)), 109: "12 + 34 = 46", 110: "é ü ß" * 30, 111: "A.\n" * 9, 112: "日本語 テキスト " * 5, 113: "<|endoftext|> y"}
    rows = [(i, t, rng.choice(["en", "fr", None]), "hot" if i % 3 else f"s{i}", len(t or ""), "r", i, "f") for i, t in texts.items()]
    return [*rows, rows[40], rows[40], (None, "no id " + texts[41], None, None, None, None, None, None), (None, None, None, None, None, None, None, None),
            (5, "another text under a used id", "en", "hot", 28, "r", 0, "f")]
