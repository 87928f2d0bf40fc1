"""Texts that are hard to cut: blanks at ends and side by side, markers, other white space, wide and rare characters."""

import random

HARD = [
    "",
    " ",
    "\n",
    "   ",
    " a",
    "a ",
    "a  b",
    "a\n b",
    "a\n\nb",
    "tab\tx",
    "no-break space",
    "\u001c",
    "it's we'll I'M",
    "a▁b ▁ ▁▁c",
    "<|endoftext|> x<|endoftext|>",
    "</s><s> <unk>",
    "ﬁ é é 一二三 힣 😀👍🏽",
    "x" * 5000,
    "word " * 5000,
    "\u0000 a",
    "12 345 6.7",
]


def mixed(seed: int, count: int, size: int = 40) -> list[str]:
    rng = random.Random(seed)
    parts = [" ", "\n", "a", "Be", "'s", "é", "\t", ".", "12", "▁", "  ", "😀", "一", "the ", "token = ", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, size))) for _ in range(count)]


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(words))
