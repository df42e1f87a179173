import random

from spanforge.llm import lines

FIELDS = "doc_id long, text string, kept string, n_words int"
PROSE = "The first line of the text has words and ends as prose does. " * 3


def repeated(words, k=8):
    wins = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    return len({i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(k)})


def test_repeated_words_against_all_windows():
    r = random.Random(1)
    for n in (0, 7, 8, 9, 60, 200):
        for kinds in (1, 2, 3, 40):
            w = [str(r.randrange(kinds)).encode() for _ in range(n)]
            assert lines.repeated_words(w) == repeated(w)
    p = [str(i).encode() for i in range(30)]
    assert lines.repeated_words(p + [b"x"] + p) == 60


def test_line_rules():
    rules = lines.Rules()

    def fails(s):
        return lines.line_fails(s.encode(), s.encode().split(), rules)

    assert fails("Home") and fails("Our products") and not fails("Yes.") and not fails("a heading with five words")
    assert fails("buy### now$$$ cheap%%%") and fails("WOW!! THIS!! IS!! IT!!") and not fails("Costs 5% more & that is all of it today.")
    assert fails("Home | News | Sport | About us") and fails("A > B > C d") and not fails("This or that | is one thing only we say in prose.")
    assert fails("Accept cookies to go on.") and fails("ALL RIGHTS RESERVED 2020.") and not fails("The cookies were good and warm.")
    assert fails("ha ha ha ha ha") and not fails("He had had that that day off.")


def test_clean_and_verdict(spark):
    t = PROSE + "\nHome | News | Sport | About\n" + PROSE + "\n \n" + PROSE + "Other."
    junk = "\n".join(["Menu"] + [f"{i} | {i + 1} | {i + 2}" for i in range(40)]) + "\n" + PROSE
    rows = [(1, t, "x", 5), (2, None, "x", 5), (3, "", "x", 5), (4, junk, "x", 5), (4, junk, "x", 5), (None, PROSE + "é" * 3, "x", 5), (6, "word " * 400000, "x", 5)]
    got = lines.clean_lines(spark.createDataFrame(rows, FIELDS)).collect()
    assert len(got) == len(rows)
    of = {x.doc_id: x for x in got}
    once = PROSE.split()
    assert of[1].n_words == 3 * len(once) + 8 and of[1].n_dup_lines == 1 and of[1].base_failed  # the same prose thrice
    assert of[1].cleaned == PROSE + "\n" + PROSE + "Other." and of[1].n_symbols == 3
    assert (of[2].n_words, of[2].word_chars, of[2].base_failed, of[2].kept, of[2].cleaned) == (0, 0, True, False, "") == (of[3].n_words, of[3].word_chars, of[3].base_failed, of[3].kept, of[3].cleaned)
    assert not of[4].kept and not of[4].base_failed and of[4].n_lost_words > 0.4 * of[4].n_words
    assert of[None].word_chars == len("".join((PROSE + "é" * 3).split()))
    assert of[6].n_repeat_words == 400000 and not of[6].kept
    assert lines.clean_lines(spark.createDataFrame([], FIELDS)).count() == 0


def test_keep_clean_keeps_columns(spark):
    good = " ".join(f"word{i}" for i in range(40)) + "."
    rows = [(1, good + "\nMenu", "x", 9), (2, "short", "x", 9), (None, good, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cleaned string, n_chars long")
    got = lines.keep_clean(df).collect()
    assert sorted((x.doc_id or 0, x.text, x.cleaned, x.n_chars) for x in got) == [(0, good, None, len(good)), (1, good, "x", len(good))]
