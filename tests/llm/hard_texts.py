"""Texts and tables that the tests of the corpus operators share."""

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "the same line\nand the next\nand one more",
    "start\nthe same line\nand the next\nend", "the same line\nand the next\nand one more",
    LONG, LONG + " more", "ééé ñññ 日本語 🎉", "x" * 5000, "a\x00b\x1cc\x85d e", "tab\tcr\rff\x0c",
]
