"""Coverage of normative text by the lists of the report contract."""

from graphloom.operators import coverage


def test_markers_of_the_contract(spark):
    told = {
        "Zinc may be co-administered.": ["may be co-administered"], "Fever is not a reason to wait.": ["is not a reason"], "Colds are not a contraindication.": ["are not a contraindication"],
        "See Recommendation 3.": ["recommendation"], "It is recommended.": ["recommended"], "You should not wait, you must go.": ["should not", "must"], "It may be  associated.": None, "A recommender speaks.": None,
    }
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate(told)], "page int, ordinal int, sentence string")
    assert {r.sentence: r.markers for r in coverage.normative(rows).collect()} == {k: v for k, v in told.items() if v}


def test_only_sound_exclusions_account_for_a_sentence(spark):
    made = [
        ("editorial", "ann", "excluded"), ("whim", "ann", "unaccounted"), ("background", "ann", "unaccounted"), ("editorial:x", "ann", "unaccounted"), ("editorial", None, "unaccounted"), ("editorial", " ", "unaccounted"),
        ("duplicate-of:https://x/rec:1", "ann", "excluded"), ("duplicate-of:https://x/rec:2", "ann", "unaccounted"), ("duplicate-of", "ann", "unaccounted"), (None, "ann", "unaccounted"),
    ]
    sentences = spark.createDataFrame([(1, i, f"You should {i}.") for i in range(len(made))], "page int, ordinal int, sentence string")
    exclusions = spark.createDataFrame([(1, i, r, by) for i, (r, by, _) in enumerate(made)], "page int, ordinal int, reason string, signed_by string")
    nodes, none = spark.createDataFrame([("https://x/rec:1",)], "id string"), spark.createDataFrame([], "sentence string")
    states = lambda *n: {r.ordinal: r.state for r in coverage.sentence_states(coverage.normative(sentences), "page", none, exclusions, *n).collect()}
    assert states(nodes) == {i: s for i, (_, _, s) in enumerate(made)}
    assert states()[6] == "unaccounted"
    assert {r.ordinal for r in coverage.check_exclusions(exclusions, nodes, "page").collect()} == {i for i, (_, _, s) in enumerate(made) if s == "unaccounted"}
