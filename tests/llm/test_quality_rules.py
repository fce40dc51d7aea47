import re

from locusweave.llm import quality_rules

PROSE = "The cat sat on the mat and it was of the house that is by the sea. "


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), n < 50 or 100 * len(again) > 50 * n


UNIQUE = " ".join(f"word{i} the and" for i in range(40))
TEXTS = [None, "", "  \n\t ", "one", "a b a b a b a b", PROSE * 10, UNIQUE, UNIQUE.upper() + "!!" * 60, UNIQUE.replace(" ", "*** "), "x\nx\n\nx \n" + UNIQUE, "é ü 😀 " * 30, "\x0b\x0c a\x0bb\x0cc", UNIQUE * 200, "|".join(UNIQUE.split()), "a a a a " + UNIQUE]


def test_counts(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 5), (None, None, 5)], "doc_id long, text string, n_words int")
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        want = brute(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, r["text"][:60]
        assert not (r["kept"] and want[-1])
    assert quality_rules.apply_rules(docs.limit(0)).collect() == []


def test_verdicts(spark):
    good, junk = UNIQUE, [UNIQUE.upper() + "!!" * 60, UNIQUE.replace(" ", "*** "), " | ".join(f"x{i}y" for i in range(90)), "short"]
    docs = spark.createDataFrame([(0, good), *enumerate(junk, 1)], "doc_id long, text string")
    assert [r["doc_id"] for r in quality_rules.apply_rules(docs).where("kept").collect()] == [0]


def test_no_function_of_ours_runs(spark):
    plan = quality_rules.apply_rules(spark.createDataFrame([(0, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
