"""Inputs shared by the tests."""

#: rows every operator must survive: nulls, empty and blank texts, repeats, a long text
HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "one two three"), (None, None),
    (6, "wörld Ünïcode ﬁ 漢字 " * 40), (7, "a" * 50_000), (8, "the end of it " * 4_000), (9, "x\x0by\x0cz\x1cq"),
    (10, "the people of the town walked to the market and bought a loaf of bread with the last of their coins today"),
]
