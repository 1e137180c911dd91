import random
from collections import Counter, defaultdict

import regex

from tests.llm.data import SCHEMA, SF, awkward, empty
from tradeline.llm import decontaminate, queries

ITEM = "Mrs Baker sold 48 apples to her friend Anna for 12 dollars and then gave Anna half of what was left over in the shop."


def found(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}


def test_other_names_and_numbers_are_caught(spark):
    asked = ITEM.replace("Anna", "Clara").replace("48", "1,250").replace("12", "7.5")
    got = found(spark, [f"Some words before.\n{ITEM} And after.", f"It said.\n{asked} End.", asked.upper()])
    assert got[0, 0].n_changed == 0
    assert got[1, 0].n_changed == 3
    assert (2, 0) not in got  # a name in capitals only is no name


def test_inconsistent_slots_are_not_the_question(spark):
    mixed = ITEM.replace("friend Anna", "friend Clara").replace("gave Anna", "gave Maria")
    same = ITEM.replace("48", "12")  # two values of the question become one
    assert found(spark, [f"x {mixed}", f"x {same}"]) == {}


def test_shape_alone_is_not_the_question(spark):
    assert found(spark, ["Mr Miller bought 3 pears from his friend Tom for 2 euros.", "Nothing of the kind."]) == {}


def test_half_of_the_windows_is_enough(spark):
    words = ITEM.split()
    assert found(spark, [" ".join(words[:19]), " ".join(words[:10])]).keys() == {(0, 0)}


def test_short_and_empty_questions(spark):
    got = found(spark, ["we ask who was it then now", "was it", ""], ["who was it", "", None, "?!"])
    assert got.keys() == {(0, 0)}


def test_repeated_question_in_a_long_text(spark):
    text = " filler words go here ".join([ITEM] * 300)
    assert found(spark, [text])[0, 0].n_matched == found(spark, [ITEM])[0, 0].n_windows


def test_awkward_rows(spark):
    docs = awkward(spark)
    bench = spark.createDataFrame(
        [(1, "One", "a"), (None, "x y z", "b"), (3, None, "c"), (3, "", "d")], "item_id long, text string, doc_id string"
    )
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()] == [(7, 1)]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert kept.count() == docs.count() - 1
    assert decontaminate.contaminated(empty(spark, SCHEMA), bench).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_IDS", 0)
    assert found(spark, [f"x {ITEM}", "no"]).keys() == {(0, 0)}


def test_copies_are_found_whatever_their_names_and_case(spark):
    sums = "12 + 7 = 19, 30 + 4 = 34, 8 + 8 = 16"
    items = ["What is the capital of France?", ITEM, sums, "Paris, Berlin, Madrid, Rome, Vienna, Oslo, Bern, Prague, Riga"]
    texts = [f"Question: {items[0]} Answer: Paris", ITEM.upper(), ITEM.lower(), f"Add up {sums}!", f"Towns: {items[3]}."]
    texts += [ITEM.replace("48", "12"), "Question: What is the capital of Spain, and of Italy?"]
    got = found(spark, texts, items)
    assert {(0, 0), (1, 1), (2, 1), (3, 2), (4, 3)} == got.keys()
    assert (got[1, 1].n_matched, got[1, 1].n_changed) == (got[1, 1].n_windows, 0)


def test_every_alignment_with_enough_windows_is_tried(spark):
    mixed = ITEM.replace("friend Anna", "friend Clara").replace("gave Anna", "gave Maria")
    assert found(spark, [f"{mixed} And later. {ITEM.replace('Anna', 'Rosa')}"]).keys() == {(0, 0)}
    filler = " and so on it goes with many other words" * 2
    assert found(spark, [filler.join([mixed] * 3), filler.join([mixed, ITEM.replace("48", "12")])]) == {}


def test_slots_count_only_where_windows_match(spark):
    """After the end of a partial copy, slots lie upon each other by accident."""
    item = "A farmer has 7 cows and sells some of them on the big market in town for 9 coins and 7 eggs."
    part = "A farmer has 5 cows and sells some of them on the big market in town but not for money, 6 hens."
    assert found(spark, [part], [item]).keys() == {(0, 0)}


def test_long_runs_of_names_and_numbers(spark):
    """No pattern may recurse as deep as a text is long."""
    names = "The list: " + "Anna Berta " * 50_000
    numbers = "Sums " + "1,2.3:4/5," * 20_000 + "6 and " + "7 " * 100_000
    slots = "0 " * 50_000 + "kg " * 50_000
    got = found(spark, [f"{names} {ITEM}", f"{numbers} {ITEM}", f"{slots} {ITEM}", "A1" * 100_000])
    assert {d for d, _ in got} == {0, 1, 2}


def brute_tokens(text):
    text = (text or "").translate({1: " ", 2: " "})
    text = regex.sub(decontaminate.NAME, "\\1\x01n\\2\x02", text)
    text = regex.sub(decontaminate.NUMBER, "\\1\x01d\\2\x02", text)
    text = regex.sub(decontaminate.UNIT, "\\1\x01u\\2\x02\\3", text)
    return regex.findall(decontaminate.TOKEN, text)


def brute(docs, items, window=8, least=0.5):
    """(doc, item) -> counts, by lists of words instead of hashes and joins."""

    def is_slot(token):
        return token.startswith("\x01")

    def windows(words, size):
        return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if size else []

    def agreeing(pairs):
        return len({q for q, _ in pairs}) == len(pairs) == len({d for _, d in pairs})

    def upon(doc, item, shift, places):
        pairs = {(item[i], doc[i + shift]) for i in places if 0 <= i + shift < len(doc) and i < len(item)}
        return {(q, d) for q, d in pairs if is_slot(q) and q[:2] == d[:2]}

    def shape(tokens):
        return [t[:2] if is_slot(t) else t.lower() for t in tokens]

    def plain(text):
        return regex.findall(decontaminate.WORD, (text or "").lower())

    out = {}
    for d, text in docs.items():
        doc = brute_tokens(text)
        for i, question in items.items():
            item = brute_tokens(question)
            size = min(window, len(item))
            first = {}
            for at, w in enumerate(windows(shape(item), size)):
                if 2 * sum(not is_slot(t) for t in item[at : at + size]) >= size:
                    first.setdefault(w, at)
            spots, seen, times = defaultdict(set), set(), Counter()
            for at, w in enumerate(windows(shape(doc), size)):
                if w in first:
                    spots[at - first[w]].add(first[w])
                    times[at - first[w]] += 1
                    seen.add(w)
            candidate = bool(first) and bool(seen) and len(seen) >= least * len(first)
            if candidate:
                order = sorted(spots, key=lambda s: (-times[s], s))
                for k, shift in enumerate(order):
                    if k and len(spots[shift]) < least * len(first):
                        continue
                    own = upon(doc, item, shift, {p + j for p in spots[shift] for j in range(size)})
                    if agreeing(own):
                        whole = upon(doc, item, shift, range(len(item)))
                        own = whole if agreeing(whole) else own
                        out[d, i] = (len(seen), len(first), len(own), sum(q != v for q, v in own))
                        break
            if (d, i) not in out:
                words = plain(question)
                size = min(window, len(words))
                wanted = set(windows(words, size))
                matched = wanted & set(windows(plain(text), size))
                if matched and len(matched) >= (len(wanted) if candidate else least * len(wanted)):
                    out[d, i] = (len(matched), len(wanted), 0, 0)
    return out


def counts(rows):
    return {(r.doc_id, r.item_id): (r.n_matched, r.n_windows, r.n_slots, r.n_changed) for r in rows}


def test_whole_operator_against_brute_force(spark):
    """Plain windows, several alignments, contradicting slots, inserted and deleted words, short questions."""
    rng = random.Random(8)
    words = "a shop sold some of the goods it had and then gave the rest to its owner for".split()
    names, kinds = ["Anna", "Bert", "Clara", "Dora"], Counter()

    def question():
        return " ".join(rng.choice([rng.choice(words), rng.choice(words), rng.choice(names), str(rng.randrange(60)), "7 kg"]) for _ in range(rng.randrange(3, 26)))

    def changed(text):
        out = []
        swap = dict(zip(names, rng.sample(names, 4)))
        for w in text.split():
            kind = rng.random()
            out += [] if kind < 0.02 else [w, rng.choice(words)] if kind < 0.04 else [swap.get(w, w) if kind < 0.9 else w]
        return " ".join(out)

    items = {i: question() for i in range(40)}
    docs = {}
    for d in range(250):
        parts = [question()]
        for _ in range(rng.randrange(4)):
            text = rng.choice(list(items.values()))
            kind = rng.randrange(5)
            parts += [[text, changed(text), text.upper(), text.lower(), text[: len(text) * 2 // 3]][kind], question()]
            kinds[kind] += 1
        docs[d] = " so ".join(parts)
    got = found(spark, list(docs.values()), list(items.values()))
    assert counts(got.values()) == brute(docs, items) and len(got) > 100


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = counts(queries.QUERIES["op6_decontamination"](spark, SF).collect())
    assert got == brute(docs, items) and got
