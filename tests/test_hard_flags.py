"""All arms of the hard flags, in the queries that report them."""

from __future__ import annotations

from corpusloom.operators import translate
from corpusloom.plans.catalog import QUERIES

SENTENCE = "The old committee met again in the town hall on a cold morning."
NEAR = f"{SENTENCE} And nobody spoke for a long time there. {SENTENCE.replace('cold', 'cool')}"
OTHER = "A wholly different text of much the same length, in which no sentence stands twice. It has two more of them. They end here, after some more words."


def test_arms(spark, tmp_path):
    turns = [(1, 1, OTHER), (1, 2, NEAR), (2, 1, OTHER), (2, 2, f"{OTHER} well well well well well"), (3, 1, OTHER), (3, 2, OTHER.replace("wholly", "fully"))]
    table = spark.createDataFrame([(c, t, "user", x) for c, t, x in turns], "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")

    def by_rank(name, column):
        return {r["rank"]: r[column] for r in QUERIES[name](spark, str(tmp_path)).collect()}

    assert by_rank("pair_flags", "hard_flags") == {1: "decoder_repetition", 2: "", 3: ""}
    assert by_rank("release_status", "hard") == {1: 1, 2: 0, 3: 0}
    assert by_rank("release_status", "status")[1] == "FAIL"
    assert by_rank("hard_flags_targeted", "flags") == {1: "", 2: "decoder_repetition", 3: ""}
    # the whole text repeats a sentence, so its first half is better; one that is nearly the source isn't the best
    assert by_rank("best_candidate", "candidate")[1] == 1
    assert by_rank("best_candidate", "candidate")[3] == 1 and by_rank("best_candidate", "clear")[1]


def test_a_nearly_repeated_sentence_is_not_clear(spark):
    rows = spark.createDataFrame([(1, OTHER, "paragraph", 0, NEAR)], "id long, source string, kind string, candidate int, translation string")
    assert [r["clear"] for r in translate.best(rows, ["id"], "en").collect()] == [False]
