import random

from rodado.llm import subjects as S

TOPICS = {
    "law": ["the court fine", "a legal appeal", "the contract clause", "a witness statement", "sign the waiver"],
    "food": ["a loaf of bread", "the onion soup", "fried potatoes", "roast the coffee", "peel the garlic"],
    "sport": ["the relay team", "a final sprint", "the winning goal", "train for the race", "the league table"],
}
PLAIN = ["bring lights and a spare tube", "the page was updated in march", "the group leaves on monday", "park beside the bridge", "turn left and keep going"]
FRAMES = ["there is more to say on {}", "most questions were about {}", "a photo of {} hangs by the door", "remember {} before you go"]


def document(rnd, topics, share=0.6):
    """(text, the topics that at least a quarter of its sentences deal with)"""
    out, dealt = [], []
    for _ in range(rnd.randint(8, 14)):
        if topics and rnd.random() < share:
            dealt.append(rnd.choice(topics))
            out.append(rnd.choice(FRAMES).format(rnd.choice(TOPICS[dealt[-1]])).capitalize() + ".")
        else:
            out.append(rnd.choice(PLAIN).capitalize() + ".")
    text = "---\nname: the court fine\n---\n\n# The court fine\n\n" + " ".join(out) + "\n\n| the court fine | x |\n|---|---|\n\n```\nthe court fine. the court fine.\n```\n<!-- the court fine. -->\n"
    return text, {t for t in TOPICS if dealt.count(t) >= len(out) / 4}


def test_sentences():
    text = "---\na: b\n---\n# Title\n\n* One [link](http://x.y). Two!\n> Three?\n| t | u |\n```\ncode. code.\n```\n<!-- no. -->\nFour `x` five\n🚲🚲\n"
    assert [" ".join(S.words(s)) for s in S.sentences(text)] == ["one link", "two", "three", "four five"]
    assert S.sentences(None) == S.sentences("") == S.sentences(" \n ") == []
    assert len(S.sentences("word " * 100_000)) == 1


def test_held_out_accuracy(spark):
    rnd = random.Random(11)
    kinds = [["law"], ["food"], ["sport"], ["law", "food"], []]
    docs = [(i, *document(rnd, kinds[i % 5])) for i in range(400)]
    rows = [(i, t, "x") for i, t, _ in docs] + [(1000, None, ""), (1001, "", ""), (1002, "🚲", "")]
    labels = [(i, t) for i, _, k in docs[:150] for t in k] + [(None, "law"), (5, None), (0, "law")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, share string")
    l = spark.createDataFrame(labels, "doc_id bigint, subject string")
    got = {(r["doc_id"], r["subject"]) for r in S.unlabelled_areas(d, l).collect()}
    labelled = {i for i, _ in labels if i is not None}
    want = {(i, t) for i, _, k in docs for t in k if i not in labelled}
    assert not {i for i, _ in got} & labelled
    assert len(got & want) >= 0.8 * len(want) and len(got & want) >= 0.93 * len(got)


def test_no_labels_and_empty(spark):
    d = spark.createDataFrame([(1, "One. Two.")], "doc_id bigint, text string")
    l = spark.createDataFrame([], "doc_id bigint, subject string")
    assert S.unlabelled_areas(d, l).collect() == []
    assert S.unlabelled_areas(d.limit(0), spark.createDataFrame([(1, "law")], l.schema)).collect() == []
