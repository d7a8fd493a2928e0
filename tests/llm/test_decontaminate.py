"""Templates, slots and leaks, planted and re-asked with other values."""

import numpy as np
from cases import table

from ebbtide.llm import decontaminate, queries
from ebbtide.llm.decontaminate import TOKEN, Template, Tokens, consistent, longest_run

QUESTION = (
    "Yesterday Maria bought 12 apples for 3 dollars at the small market near the river and then gave 5 apples to her friend Tom "
    "before she walked 4 km back home where Maria counted what was left"
)
AGAIN = (
    "Yesterday Selma bought 40 apples for 9 dollars at the small market near the river and then gave 7 apples to her friend Otto "
    "before she walked 6 km back home where Selma counted what was left"
)
WRONG = AGAIN.replace("where Selma", "where Otto")
SHORT = "who wrote it first"
PLAIN = "nothing here has to do with any of the questions that were asked in the benchmark at all but it is long enough"


def leaks(spark, texts, items=((1, QUESTION), (2, SHORT), (3, None), (4, "")), **options):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    docs, asked = table(spark, rows), table(spark, list(items), "item_id long, text string")
    found = {r["doc_id"]: r["_item_ids"] for r in decontaminate.contaminated(docs, asked, **options).collect()}
    listed = {r["doc_id"]: r["items"] for r in decontaminate.report(docs, asked, **options).collect()}
    assert listed == {i: ",".join(map(str, ids)) for i, ids in found.items() if ids}
    return found


def test_whole_partial_and_asked_again(spark):
    half = " ".join(QUESTION.split()[:20])
    texts = [QUESTION, f"before this. {AGAIN} And after.", WRONG, half, PLAIN, SHORT, f"well, {SHORT}?", None, "", f"{QUESTION}\n\n{SHORT}", QUESTION.upper()]
    assert leaks(spark, texts) == {0: [1], 1: [1], 2: [], 3: [1], 4: [], 5: [2], 6: [2], 7: [], 8: [], 9: [1, 2], 10: []}


def test_against_windows_by_hand(spark, folder):
    import re

    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    true = {i: sorted(k for k, q in items if plain(q) in plain(t)) for i, t in docs}
    assert any(true.values())
    texts = table(spark, [(i, t, "en", "s") for i, t in docs])
    found = decontaminate.report(texts, table(spark, items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["items"] for r in found} == {i: ",".join(map(str, v)) for i, v in true.items() if v}


def test_items_of_one_template_are_one_class(spark):
    assert leaks(spark, [AGAIN], [(7, QUESTION), (5, AGAIN), (9, QUESTION)]) == {0: [5]}


def test_items_of_one_template_with_other_values_are_found(spark):
    ask = "there are {0} red apples and {1} green pears in the box and then {0} of them are eaten while {1} are left"
    items = [(1, ask.format(3, 3)), (2, ask.format(5, 7)), (None, ask.format(6, 8).replace("red", "ripe").replace("left", "sold"))]
    found = leaks(spark, [ask.format(5, 7), ask.format(9, 4), ask.format(9, 9), items[2][1]], items, least_cover=0.9)
    assert found[0] == [2] and found[1] == [2] and found[2] == [1] and len(found[3]) == 1 and found[3][0] < 0
    slots = "Ann Bob {} Cid {} Dan Eve {} Fay Gus {} Hal"
    assert leaks(spark, [slots.format(5, 6, 7, 8)], [(1, slots.format(1, 2, 3, 4)), (2, slots.format(5, 6, 7, 8))]) == {0: [2]}


def test_words_in_any_case(spark, tmp_path):
    texts = [QUESTION.upper(), QUESTION.lower(), AGAIN, AGAIN.upper(), SHORT.title(), PLAIN]
    assert leaks(spark, texts, any_case=True) == {0: [1], 1: [1], 2: [1], 3: [], 4: [2], 5: []}
    table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, [(1, QUESTION), (2, SHORT)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r["doc_id"] for r in queries.op6_decontaminate(spark, str(tmp_path)).collect()) == [0, 1, 2, 4]


def test_verbatim_parts_and_all_alignments_count(spark):
    words = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "je") for b in ("lor", "min", "nes", "pat", "rov", "sub", "tik", "wun", "xar", "zol")]
    item = " ".join(words[:70])
    inserted = " ".join(w + " and so" * (i % 14 == 13) for i, w in enumerate(words))
    numbered = " ".join("3" if i in (5, 60) else w for i, w in enumerate(words))
    changed = " ".join("4" if i == 60 else "3" if i == 5 else w for i, w in enumerate(words))
    options = {"items": [(1, item), (2, numbered)], "least_cover": 0.8}
    assert leaks(spark, [inserted, changed], **options) == {0: [1], 1: [2]}
    assert leaks(spark, [WRONG, AGAIN, PLAIN], partial=True) == {0: [1], 1: [1], 2: []}


def test_largest_consistent_part():
    pairs = [{("a", "b")}, {("a", "c"), ("d", "e")}, {("d", "e")}, {("d", "e"), ("f", "g")}, {("a", "b"), ("a", "c")}]
    windows = {(i, 2): p for i, p in enumerate(pairs)}
    assert consistent(windows, False) == set()
    assert consistent(windows, True) == {(0, 2), (2, 2), (3, 2)}
    assert longest_run({w: windows[w] for w in list(windows)[:4]}) == {(1, 2), (2, 2), (3, 2)}
    assert consistent({w: windows[w] for w in list(windows)[1:4]}, False) == {(1, 2), (2, 2), (3, 2)}


def test_no_benchmark(spark):
    assert leaks(spark, [QUESTION], []) == {0: []}


def test_kinds_and_windows():
    tokens = TOKEN.findall("It's 5kg, or 5 kg: Tom-Lee has 1,000.5 c and c")
    assert tokens == ["It's", "5", "kg", "or", "5", "kg", "Tom-Lee", "has", "1,000.5", "c", "and", "c"]
    _, kinds = Tokens().of(tokens)
    assert kinds.tolist() == [2, 1, 3, 0, 1, 3, 2, 0, 1, 3, 0, 0]
    one, other = Template("a b Tom d 5 f g h".split(), Tokens()), Template("a b Ann d 7 f g h".split(), Tokens())
    assert np.array_equal(one.windows(6)[1], other.windows(6)[1])
    names = [Template(w.split(), Tokens()).windows(4) for w in ("Tom Ann Lee has", "Tom Ann Joe has")]
    assert names[0][3].all() and not np.array_equal(names[0][1], names[1][1])


def plain_matches(docs, items, size, least_cover):
    """The registered behaviour by plain loops over all windows of all texts and items."""
    from ebbtide.llm.decontaminate import LITERAL, one_to_one

    cache = Tokens()

    def read(text):
        tokens = TOKEN.findall(text or "")
        return [t.lower() for t in tokens], cache.of(tokens)[1].tolist()

    asked = {}
    for item_id, text in items:
        tokens, kinds = read(text)
        if tokens:
            asked.setdefault(tuple(tokens), (item_id, kinds))
    classes = {}
    for tokens, (item_id, kinds) in asked.items():
        slots = [t for t, k in zip(tokens, kinds) if k != LITERAL]
        shape = tuple(t if k == LITERAL else k for t, k in zip(tokens, kinds)), tuple(slots.index(t) for t in slots)
        classes.setdefault(shape, []).append((item_id, tokens, kinds))
    found = {}
    for row, (doc_id, text) in enumerate(docs):
        own, own_kinds = read(text)
        for members in classes.values():
            members.sort(key=lambda m: m[0])
            length = len(members[0][1])
            n = min(size, length)
            shaped, equal = {}, {}
            for m, (_, tokens, kinds) in enumerate(members):
                for at in range(length - n + 1):
                    slotted = [i for i in range(at, at + n) if kinds[i] != LITERAL]
                    for start in range(len(own) - n + 1):
                        here = own[start : start + n]
                        if here == list(tokens[at : at + n]):
                            equal.setdefault(m if slotted else None, set()).add((start - at, at))
                        if m or 2 * (n - len(slotted)) < n or not slotted:
                            continue
                        if [(t if k == LITERAL else k) for t, k in zip(tokens[at : at + n], kinds[at : at + n])] == [
                            (t if k == LITERAL else k) for t, k in zip(here, own_kinds[start : start + n])
                        ]:
                            pairs = {(tokens[i], own[start + i - at]) for i in slotted}
                            shaped.setdefault(start - at, {})[at, n] = pairs
            best = {}
            for m in {0, *equal} - {None}:
                same = equal.get(None, set()) | equal.get(m, set())
                covered = {i for _, at in same for i in range(at, at + n)}
                for shift, windows in shaped.items():
                    rest = {w: p for w, p in windows.items() if (shift, w[0]) not in same}
                    covered |= {i for at, k in consistent(rest, True) for i in range(at, at + k)}
                best[members[m][0]] = len(covered) / length
            for item_id, cover in best.items():
                if cover >= least_cover:
                    found.setdefault(row, {})[item_id] = max(cover, found.get(row, {}).get(item_id, 0))
    return {docs[row][0]: (",".join(map(str, sorted(ids))), max(ids.values())) for row, ids in found.items()}


def varied(text, draw):
    """The question asked again: every number and every capitalised word replaced, alike where alike."""
    given = {}

    def other(m):
        token = m[0]
        if token[0].isdigit():
            return given.setdefault(token, str(draw.randrange(1000, 9999)))
        return given.setdefault(token, "Z" + "".join(draw.choices("aeiourstln", k=7))) if token[0].isupper() else token

    return TOKEN.sub(other, text)


def test_registered_query_against_plain_loops(spark, tmp_path):
    import random

    draw = random.Random(11)
    small = [f"{a}{b}" for a in ("mo", "ta", "ri", "ku") for b in ("le", "na", "so", "pi", "du")]

    def question():
        words = draw.choices(small, k=draw.randint(6, 30))
        for i in range(0, len(words), 5):
            words[i] = draw.choice(["Ann", "Bob", "12", "7", "3 km", "40 kg", "Cid"])
        return " ".join(words)

    items = [(i, question()) for i in range(1, 13)]
    items += [(13, varied(items[0][1], draw)), (14, "who wrote it"), (15, None), (16, "")]
    docs = []
    for i in range(60):
        parts = [question() for _ in range(draw.randrange(3))]
        own = draw.choice(items[:14])[1]
        cut = own.split()
        parts.append(draw.choice([own, own.upper(), varied(own, draw), " ".join(cut[: len(cut) // 2 + 3]), own.replace("Ann", "Dee", 1), " so ".join(own.split(" ", 9))]))
        docs.append((i, draw.choice([" ", "\n", ". "]).join(parts)))
    docs += [(100, None), (101, "")]
    table(spark, docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: (r["items"], r["cover"]) for r in queries.op6_decontaminate(spark, str(tmp_path)).collect()}
    wanted = plain_matches(docs, items, 12, 0.25)
    assert got == wanted and len(wanted) > 30


def test_recall_of_questions_asked_again(spark, folder):
    """Every item of the test benchmark with other numbers and names, inside other text."""
    import random

    import duckdb

    draw = random.Random(12)
    items = [r for r in duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()]
    again = [(i, f"{PLAIN}. {varied(text, draw)} {PLAIN}") for i, text in items]
    found = leaks(spark, [t for _, t in again], items, any_case=True, partial=True)
    hit = sum(i in found[n] for n, (i, _) in enumerate(again))
    assert hit >= 0.9 * len(items)


def test_texts_of_a_slice_do_not_run_into_one_another(spark):
    words = QUESTION.split()
    texts = [*[" ".join(words[i : i + 8]) for i in range(0, len(words), 8)], "", None, "5", "kg of it"]
    assert leaks(spark, texts) == dict.fromkeys(range(len(texts)), [])
