from __future__ import annotations

import collections
import re

import pytest
from pyspark.sql import functions as F

from tallystick.llm import queries, quality_rules
from tallystick.llm.oracles import statements
from tests.comparing import compare, duck
from tests.llm.frames import PROSE, documents


def judged(spark, texts, rules=quality_rules.RULES):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = frame.select("i", quality_rules.judged(F.col("text"), rules).alias("m")).orderBy("i").collect()
    return [r["m"] for r in rows]


def repeated(words):
    counts = collections.Counter(zip(words, words[1:], words[2:]))
    return len({i + k for i in range(len(words) - 2) if counts[tuple(words[i : i + 3])] > 1 for k in range(3)})


def test_counts_by_hand(spark):
    (m,) = judged(spark, ["a b c a b c\n\n a b c a b c\n# x*\n a b c a b c\n- THE Über 4 ...\n"])
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_lines) == (25, 33, 2, 1, 5)
    assert m.n_repeat_words == repeated("a b c a b c a b c a b c # x* a b c a b c - THE Über 4 ...".split())
    assert (m.n_stop_words, m.n_capital_words, m.n_bullet_lines, m.n_cut_lines) == (1, 1, 1, 1)


def test_repeated_words_like_a_plain_count(spark):
    texts = ["".join("ab"[i * k % 7 % 2] + " " for i in range(60)) for k in range(1, 9)] + [PROSE, PROSE + " " + PROSE, "", "x y", "x x x x"]
    for text, m in zip(texts, judged(spark, texts), strict=True):
        assert m.n_repeat_words == repeated(re.findall(r"[^\x20\x09-\x0D]+", text)), text


def test_table_of_thresholds(spark):
    rule = quality_rules.Rule
    rules = [rule("few", "n_words", least=3), rule("many", "n_words", most=4), rule("signs", "n_symbols", "n_words", most=250)]
    found = [m.failed for m in judged(spark, ["a b", "a b c", "a b c #", "a b # %", "a b c d e", None], rules)]
    assert found == [["few"], [], [], ["signs"], ["many"], ["few"]]


def test_awkward_rows(spark):
    frame = documents(spark)
    rows = frame.select("doc_id", "text", quality_rules.judged(F.col("text")).alias("m")).collect()
    assert len(rows) == frame.count()
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        m = row["m"]
        assert (m.n_words, m.word_chars, m.n_repeat_words) == (len(words), sum(map(len, words)), repeated(words))
        assert m.base_failed == (len(words) < 50 or 2 * m.n_repeat_words > len(words)) and not (m.base_failed and m.kept)
    assert frame.limit(0).select(quality_rules.judged(F.col("text"))).count() == 0


def test_no_user_functions_and_no_shuffle(spark):
    plan = documents(spark).select(quality_rules.judged(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1  # the fixture's own


@pytest.mark.parametrize("name", ["op11_quality_rules", "op12_conversation_trie", "op13_lexical_search"])
def test_query_equals_sql(spark, star_folder, name):
    count, problems = compare(spark, duck(star_folder), star_folder, queries.registered()[name], statements()[name])
    assert count and not problems
