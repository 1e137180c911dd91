import random

from tests.llm.data import SCHEMA, SF, awkward, empty, prose
from tradeline.llm import queries, substrings


def brute(rows, least_sentences=2, least_words=substrings.WORDS):
    """doc_id -> cleaned text; spans compared as text, in order of the documents.

    A span is a run of sentences with enough words, or one such sentence, that is none any more without its
    first or without its last sentence.
    """
    cut = {i: [t[a:b] for a, b in zip(c, c[1:])] for i, t in rows if t for c in [substrings.sentences(t)]}
    words = {i: [s.lower().split() for s in parts] for i, parts in cut.items()}

    def spans(i):
        n = len(words[i])
        total = [0]
        for w in words[i]:
            total.append(total[-1] + len(w))

        def enough(a, b):
            alone = b - a == 1
            return total[b] - total[a] >= least_words and (alone or b - a >= least_sentences) if b > a else False

        for a in range(n):
            for b in range(a + 1, n + 1):
                if enough(a, b):
                    if not enough(a, b - 1) or not enough(a + 1, b):
                        yield a, b, " ".join(w for s in words[i][a:b] for w in s)
                    if enough(a + 1, b):
                        break

    owner = {}
    for i in sorted(cut):
        for a, b, span in spans(i):
            owner.setdefault(span, (i, a))
    out = dict(rows)
    for i, parts in cut.items():
        gone = {k for a, b, span in spans(i) if owner[span] != (i, a) for k in range(a, b)}
        if gone:
            out[i] = "".join(p for k, p in enumerate(parts) if k not in gone).rstrip()
    return out


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.QUERIES["op10_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: r.text for r in found} == brute(rows)
    assert all((r.n_removed > 0) == (r.text != dict(rows)[r.doc_id]) or r.text == dict(rows)[r.doc_id].rstrip() for r in found)


def test_passage_in_many_texts_stays_once(spark):
    passage = prose(77, 7)
    rng = random.Random(1)
    rows = []
    for i in range(200):
        own = prose(1000 + i, 10).split()
        at = rng.randrange(len(own))
        rows.append((i, " ".join([*own[:at], passage, *own[at:]])))
    rows += [(500 + i, prose(5000 + i, 10)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in substrings.remove_repeats(df).collect()}
    assert got == brute(rows)
    middle = " ".join(passage.split()[12:40])
    assert [i for i, t in got.items() if middle in t] == [0]
    assert all(got[i] == t for i, t in rows if i >= 500 or i == 0)


def test_repeats_inside_a_text_keep_the_first(spark):
    block = prose(5, 4)
    text = f"{block} {prose(6, 3)} {block.upper()} {block}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = substrings.remove_repeats(df).first()
    assert row.text.startswith(block) and row.text.lower().count(block[:40].lower()) == 1


def test_sentences_cover_the_text():
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choice(["A", "b", ". ", "? ", "\n", " ", "word", "Über", "…", "!) "]) for _ in range(rng.randrange(30)))
        bounds = substrings.sentences(text)
        assert bounds[0] == 0 and bounds[-1] == len(text) and bounds == sorted(set(bounds))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = substrings.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    text = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert text[1] == prose(1) and text[2] == "" and text[3] is None and text[4] == "" and text[5] == " \t\n "
    assert {r.text for r in rows if r.doc_id is None} == {prose(2), None}
    cleaned = substrings.clean_documents(docs)
    assert cleaned.schema.simpleString() == docs.schema.simpleString()
    ids = [r.doc_id for r in cleaned.collect()]
    assert 2 not in ids and ids.count(1) == 2 and ids.count(None) == 2
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cleaned.collect())
    assert substrings.clean_documents(empty(spark, SCHEMA)).collect() == []


def test_a_letter_that_grows_in_lower_case_changes_no_other(spark):
    passage = prose(31, 8)
    df = spark.createDataFrame([(1, f"{prose(32, 3)} {passage}"), (2, f"İstanbul. {passage} {prose(33, 3)}")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substrings.remove_repeats(df).collect()}
    assert passage in got[1] and " ".join(got[2].split()) == f"İstanbul. {prose(33, 3)}"


def invented(rng, n, marks):
    """Words with sentence marks and capitals, or without any."""
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n)]
    if marks:
        at = 0
        while at < n:
            words[at] = words[at].capitalize()
            at += rng.randrange(4, 25)
            words[min(at, n) - 1] += rng.choice([".", ".", "!", "?"])
            if at - 3 > 0 and rng.random() < 0.5:
                words[min(at, n) - 3] += ","
    return words


def without(passage, text):
    """Share of the passage's runs of three words that are gone from the text."""
    kept = set(zip(text.split(), text.split()[1:], text.split()[2:]))
    own = list(zip(passage, passage[1:], passage[2:]))
    return sum(t not in kept for t in own) / len(own)


def test_word_level_passages_of_over_50_words_go(spark):
    """Passages with and without marks, cut out and pasted in at any word; the first document keeps its own."""
    rng = random.Random(12)
    rows, planted = [], []
    for k in range(300):
        source = invented(rng, 200, marks=k % 3 != 0)
        size = rng.randrange(51, 90)
        at = rng.randrange(200 - size) if k % 2 else 0
        passage = source[at : at + size]
        for copy in range(3):
            own = invented(rng, 150, marks=k % 5 != 0)
            place = rng.randrange(150)
            rows.append((3 * k + copy, " ".join([*own[:place], *passage, *own[place:]])))
            planted.append(passage)
    rows += [(10_000 + k, " ".join(invented(rng, 200, marks=k % 2 == 0))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.remove_repeats(df).collect()}
    assert all(got[i].text == t and got[i].n_removed == 0 for i, t in rows if i >= 10_000 or i % 3 == 0)
    copies = [i for i, _ in rows if i < 10_000 and i % 3]
    caught = [i for i in copies if got[i].n_removed]
    assert len(caught) >= 0.98 * len(copies)
    shares = [without(planted[i], got[i].text) for i in caught]
    assert sum(shares) / len(shares) > 0.9
    # What stood around the passage is mostly left.
    text = dict(rows)
    left = [len(got[i].text.split()) / (len(text[i].split()) - len(planted[i])) for i in caught]
    assert sum(left) / len(left) > 0.95


def test_a_long_sentence_is_a_span(spark):
    own = "word" + " word" * 79
    assert substrings.spans(" ".join(["bb"] * 60), 2, 40)[0] in (1, 60)
    df = spark.createDataFrame([(1, f"One. {own}. Two"), (2, f"Three. {own}. Four")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substrings.remove_repeats(df).collect()}
    assert "word" not in got[2] and got[2].split() == ["Three.", "Four"]


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = [(i, f"{prose(100 + i, 3)} {prose(7, 8)}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(substrings.remove_repeats(df).collect())
    monkeypatch.setattr(substrings, "BROADCAST_IDS", -1)
    assert sorted(substrings.remove_repeats(df).collect()) == want
    assert [r.n_removed > 0 for r in want] == [False] + [True] * 19
