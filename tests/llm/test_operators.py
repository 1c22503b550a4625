"""Each operator against a brute-force version, a round trip or held-out labels, on small tables."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from oracle import connect, differences
from tokenizers import Tokenizer

from tidemark.llm import QUERIES, SQL, binary_packing, decontaminate, license_scan, linefreq, neighbours, packing, quality, simhash, toxicity, urls
from tidemark.llm.common import labelled_sample, ready
from tidemark.llm.tokens import document_ids

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


@pytest.fixture(scope="module")
def documents(session):
    return session.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {row["doc_id"]: row["text"] for row in documents.collect()}


# --- Toxicity ----------------------------------------------------------------------------------------------------


def language(words):
    counts = toxicity.count_ngrams([" ".join(words)]).reshape(32, 32, 32, 32).astype(float)
    probability = np.full(32, 1 / 28)
    for order in range(4):
        seen = counts.sum(axis=tuple(range(3 - order)))
        kinds = (seen > 0).sum(axis=-1, keepdims=True) + 1.0
        probability = (seen + kinds * probability) / (seen.sum(axis=-1, keepdims=True) + kinds)
    return np.log(probability)


@pytest.mark.parametrize(
    ("written", "meant"),
    [("w1nt3r", "winter"), ("wiiiinter", "winter"), ("w.i.n.t.e.r", "winter"), ("h0u$e", "house"), ("g4rd*n", "garden")],
)
def test_obfuscated_words_are_restored(written, meant):
    model = language(["winter", "house", "garden", "summer", "good"] * 50)
    assert meant in toxicity.readings(written, model)


@pytest.mark.parametrize(
    "written, meant", [("!d!0t", "idiot"), ("(!d!0t)", "idiot"), ("gra$$", "grass"), ("+ru|", "trul"), ("spi+", "spit"), ("*pple,", "apple")]
)
def test_marks_at_the_edges_may_be_letters(written, meant):
    model = language(["idiot", "grass", "trul", "spit", "apple", "an", "to"] * 30)
    assert meant in toxicity.readings(written, model)
    assert toxicity.readings("idiot!", model)[0] == "idiot"


def test_letters_set_apart_are_joined():
    model = language(["winter", "house", "a", "in"] * 50)
    assert toxicity.spaced_words("see w i n t e r now", model) == ["winter"]
    assert toxicity.spaced_words("no such letters", model) == []


def test_search_finds_the_best_reading():
    """Against every reading of the lattice, scored one by one."""
    model = language(["winter", "wilt", "lint", "tile"] * 20)
    for word in ("w1lt", "t1l3", "1int", "t!1e"):
        best = (-1e9, "")
        paths = [((), 0.0)]
        for slot in toxicity.lattice(word):
            paths = [(letters + more, cost + extra) for letters, cost in paths for more, extra in slot]
        for letters, score in paths:
            state = (0, 0, 0)
            for code, _ in [*letters, (0, "")]:
                if code or state[2]:
                    score += model[(*state, code)]
                state = (0, 0, 0) if code == 0 else (*state[1:], code)
            best = max(best, (score, "".join(letter for _, letter in letters)))
        assert toxicity.restore(word, model) == best[1]


def test_toxicity_on_held_out_labels(session):
    found = QUERIES["op2_toxicity"](session, "/root/testdata/sf0.01")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([row["predicted"] == row["toxic"] for row in rows]) > 0.9
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


# --- Lines -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(session, name):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        assert differences(session, name, folder, QUERIES, SQL, connect(folder)) is None


def test_boilerplate_is_relative_to_its_site(session):
    rows = [(k, "a" if k < 40 else "b", f"own {k}\nfooter\n\nown too {k}") for k in range(100)]
    rows += [(100 + k, "b", f"page {k}") for k in range(1000)] + [(2000 + k, "a", "copied\ntext") for k in range(50)]
    cleaned, lines, dropped = linefreq.drop_boilerplate(session.createDataFrame(rows, "doc_id long, host string, text string"), "host", "text", 0.06)
    got = {row["doc_id"]: row for row in cleaned.collect()}
    assert got[3]["text"] == "own 3\n\nown too 3" and got[3][dropped] == 1 and got[3][lines] == 4
    assert got[50]["text"].count("footer") == 1  # 60 of 1,060 pages
    assert got[2000]["text"] == "copied\ntext"  # copies are one page


# --- SimHash -----------------------------------------------------------------------------------------------------


def plain_fingerprint(text, size=4):
    words = [word for word in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if word]
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= bits:
            parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_golay_code_is_perfect():
    words = np.random.default_rng(1).integers(0, 1 << 23, 20_000)
    index = simhash.decode(words)
    codewords = words ^ simhash.errors()[simhash.syndrome(words)]
    assert (simhash.syndrome(codewords) == 0).all() and (codewords >> 11 == index).all()
    assert max(int(a ^ b).bit_count() for a, b in zip(words.tolist(), codewords.tolist())) == 3


def test_keys_cover_every_difference_of_four_bits():
    chance = random.Random(2)
    one = [chance.getrandbits(64) for _ in range(4000)]
    other = []
    for value in one:
        for bit in chance.sample(range(64), chance.randint(0, 4)):
            value ^= 1 << bit
        other.append(value)
    sides = []
    for side, values in ((0, one), (1, other)):
        row, key, _ = simhash.keys(np.array(values, dtype=np.uint64).view(np.int64), side)
        held = defaultdict(set)
        for r, k in zip(row.tolist(), key.tolist()):
            held[r].add(k)
        sides.append(held)
    assert all(sides[0][k] & sides[1][k] for k in range(len(one)))


def test_simhash_against_brute_force(session, texts):
    chance = random.Random(3)
    rows = [(k, text) for k, text in texts.items()]
    for k, text in list(texts.items())[:60]:
        words = text.split(" ")
        words[chance.randrange(len(words))] = "changed"
        rows.append((1000 + k, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One two"), (5004, "one\x0btwo"), (0, texts[0])]
    got = simhash.simhash_components(session.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {k: plain_fingerprint(text) for k, text in rows}
    roots = plain_components(sorted(set(prints.values())))
    smallest = {}
    for k, p in prints.items():
        smallest[roots[p]] = min(k, smallest.get(roots[p], k))
    assert len(got) == len(rows)
    for row in got:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == smallest[roots[prints[row["doc_id"]]]]


def test_components_of_a_long_chain(session):
    edges = session.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {row["node"]: row["comp"] for row in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_one_document_of_each_group_stays(session):
    chance = random.Random(4)
    words = [f"word{k}" for k in range(2000)]
    rows, origin = [], {}
    for group in range(12):
        base = [chance.choice(words) for _ in range(200)]
        for copy in range(5):
            text = list(base)
            if copy > 1:
                text[chance.randrange(200)] = "other"
            rows.append((len(rows), " ".join(text), "en", "s", 1))
            origin[len(rows) - 1] = group
    rows += [rows[0]] * 3
    kept = simhash.keep_one_of_each(session, session.createDataFrame(rows, documents_schema), "").collect()
    assert sorted(origin[row["doc_id"]] for row in kept) == list(range(12))
    assert all(row["doc_id"] % 5 == 0 for row in kept)


def test_near_copies_against_brute_force(session, texts):
    """Every link counts, also those between texts that are far apart in the order under a key."""
    chance = random.Random(8)
    words = [f"w{k}" for k in range(60)]
    rows = list(texts.items())
    # Few different words: all these fingerprints are close, whatever the order of the words.
    for group in range(60):
        base = [chance.choice(words) for _ in range(chance.choice([60, 240, 400]))]
        for _ in range(chance.choice([1, 2, 4])):
            text = list(base)
            for _ in range(chance.randrange(3)):
                text[chance.randrange(len(text))] = chance.choice(words)
            rows.append((1000 + len(rows), " ".join(text)))
    rows += [(9000, None), (9001, "")]
    table = session.createDataFrame([(k, text, "en", "s", 1) for k, text in rows], documents_schema)
    kept = {row["doc_id"] for row in simhash.keep_one_of_each(session, table, "").collect()}
    assert kept == linked_by_similarity(rows)[1]


def test_golay_keys_of_one_bit_sketches(session, texts):
    """All pairs within four bits of a sketch are candidates, and these are most pairs of close copies."""
    chance = random.Random(14)
    long = [text for _, text in texts.items() if 100 <= len((text or "").split()) <= 500]
    rows = []
    for k in range(150):
        base = chance.choice(long).split()
        rows.append((2 * k, " ".join([f"n{k}", *base])))
        for _ in range(1 + k % 6):
            base[chance.randrange(len(base))] = "other"
        rows.append((2 * k + 1, " ".join([f"n{k}", *base])))
    sketches = {}
    for k, text in rows:
        least = simhash.least_hashes(np.unique(simhash.shingle_hashes(text, 5)))
        sketches[k] = [int(x) & 0xFFFFFFFFFFFFFFFF for x in simhash.one_bit_sketches(least)]
    near = {
        (max(a, b), min(a, b))
        for a, b in combinations(sketches, 2)
        if any((x ^ y).bit_count() <= 4 for x, y in zip(sketches[a], sketches[b]))
    }
    prints = session.createDataFrame(rows, "node long, text string").select("node", simhash.shingle_sketch("text", 5).alias("s"))
    nodes = simhash.sketch_nodes(prints.select("node", "s.*"))
    found = {(row["a"], row["b"]) for row in simhash.key_pairs(nodes.withColumn("comp", F.col("node"))).collect()}
    assert found == near
    pairs = {(max(p), min(p)) for p in linked_by_similarity(rows)[0]}
    assert len(pairs & near) > 0.7 * len(pairs) > 50


def linked_by_similarity(rows, similarity=0.8):
    """Pairs of ids, and the smallest id of each group, by the sets of shingles alone."""
    sets = {k: set(simhash.shingle_hashes(text, 5).tolist()) for k, text in rows}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    pairs = []
    for one, other in combinations(sets, 2):
        shared, either = len(sets[one] & sets[other]), len(sets[one] | sets[other])
        if either == 0 or shared >= similarity * either:
            pairs.append((one, other))
            first, second = sorted((root(one), root(other)))
            parent[second] = first
    return pairs, {k for k in parent if root(k) == k}


def test_near_copies_by_similarity_alone(session, texts):
    """Substituted, appended and prepended copies of texts of the table, without any condition but the similarity."""
    chance = random.Random(12)
    rows = [(k, text) for k, text in texts.items() if k is not None]
    long = [text for _, text in rows if 100 <= len((text or "").split()) <= 500]
    for k in range(90):
        base, more = chance.choice(long).split(), chance.choice(long).split()
        share = chance.choice([0.05, 0.12, 0.18, 0.24])
        if k % 3:
            added = more[: int(share * len(base))]
            copy = base + added if k % 3 == 1 else added + base
        else:
            copy = list(base)
            for _ in range(max(1, int(share * len(base) / 12))):
                copy[chance.randrange(len(copy))] = chance.choice(more)
        rows.append((5000 + k, " ".join(copy)))
    pairs, expected = linked_by_similarity(rows)
    gated = {k: [simhash.majority(simhash.remix(np.unique(simhash.shingle_hashes(text, 1)), salt)) for salt in (1, 2, 3)] for k, text in rows}
    lost = [p for p in pairs if not any((x ^ y).bit_count() <= 4 for x, y in zip(gated[p[0]], gated[p[1]]))]
    assert len(pairs) > 60 and len(lost) > 10  # of these, word fingerprints within four bits lose many
    table = session.createDataFrame([(k, text, "en", "s", 1) for k, text in rows], documents_schema)
    assert {row["doc_id"] for row in simhash.keep_one_of_each(session, table, "").collect()} == expected


def test_keys_of_similar_sets_meet():
    chance = np.random.default_rng(3)
    for size in (9, 90, 2700):
        met = 0

        def keys(values):
            return set(simhash.least_keys(simhash.least_hashes(values)))

        for _ in range(200):
            values = np.unique(chance.integers(0, 1 << 63, size + size // 9 * 2, dtype=np.uint64))
            one, other = values[: size + size // 9], np.concatenate([values[:size], values[size + size // 9 :]])
            met += bool(keys(one) & keys(other))  # 9 of 11 in common
        assert met == 200


def test_sketches_never_overstate_a_difference():
    chance = np.random.default_rng(5)

    def sketch(values):
        places = 1 << max(6, len(values).bit_length())
        odd = np.bincount(values & (places - 1), minlength=places) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    for size in (0, 1, 63, 64, 500, 2047, 2048):
        for extra in (0, 1, 40, 600, 3000):
            values = np.unique(chance.integers(0, 1 << 62, size + extra))
            assert simhash.odd_places(sketch(values[:size]), sketch(values)) <= len(values) - min(size, len(values))
            assert simhash.odd_places(sketch(values), sketch(values)) == 0


documents_schema = "doc_id long, text string, lang string, source string, n_chars long"


# --- Decontamination ---------------------------------------------------------------------------------------------

QUESTION = (
    "A farmer named Alice sold 48 apples to the market and then walked 12 km home before dinner while her friend Bob "
    "sold 36 pears and then walked 12 km back to the village near the river"
)


def leak(session, *texts):
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = session.createDataFrame([(7, QUESTION), (8, "too short"), (9, None)], "item_id long, text string")
    return {row["doc_id"]: row for row in decontaminate.leaks(docs, items).collect()}


def test_reparameterised_questions_are_found(session):
    changed = QUESTION.replace("Alice", "Mary").replace("48", "1,250").replace("12 km", "9 miles").replace("36", "77")
    muddled = QUESTION.replace("12 km home", "5 km home").replace("12 km back", "6 km back").replace("48", "12").replace("36", "13")
    got = leak(session, f"Some words before. {QUESTION}. And after.", f"x {changed}", muddled, "Nothing of that kind here at all.", None, "")
    assert got[0]["changed"] is False and got[0]["consistency"] == 1.0
    assert got[1]["changed"] is True and got[1]["item_id"] == 7
    assert set(got) <= {0, 1, 2} and 3 not in got


def test_windows_against_plain_sets(session):
    found = QUERIES["op3_decontaminate"](session, "/root/testdata/sf0.01").collect()
    folder = "/root/testdata/sf0.01"

    def windows(text):
        words = re.findall(r"\w+", (text or "").lower())
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    items = {row["item_id"]: windows(row["text"]) for row in session.read.parquet(f"{folder}/benchmark.parquet").collect()}
    expected = set()
    for row in session.read.parquet(f"{folder}/documents.parquet").collect():
        held = windows(row["text"])
        expected |= {(row["doc_id"], item) for item, own in items.items() if own and len(own & held) >= 0.8 * len(own)}
    assert expected and {(row["doc_id"], row["item_id"]) for row in found} == expected


def test_copies_in_other_capitals_or_lines_are_found(session):
    asked = "Which city did Marie Curie move to from Warsaw in 1891 to study at the Sorbonne"
    items = session.createDataFrame([(1, asked)], "item_id long, text string")
    copies = [
        asked, asked.lower(), asked.upper(), asked.replace(" ", "\n"), asked.replace(" ", "  "), f"So they wrote\n{asked.lower()}",
        asked.replace("1891", "1902"), asked.lower().replace("marie curie", "ada lovelace").replace("warsaw", "london"),
    ]
    docs = session.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    found = {row["doc_id"]: row for row in decontaminate.leaks(docs, items).collect()}
    assert set(found) == set(range(7)) and [k for k, row in found.items() if row["changed"]] == [6]


def test_items_without_evidence_are_found_as_they_are(session):
    texts = ["What is 12 + 35 * 4?", "Solve for x", "Alice, Bob, Carol, Dave, Erin, Frank", "zebra", None, "?!", "a " * 30 + "b"]
    items = session.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    copies = [
        "Before. what is 12 + 35 * 4 ? After", "What is 13 + 35 * 4?", "first Solve\nFOR x, then", "Solve it for x",
        "and Alice, Bob, Carol, Dave, Erin, Frank met", "and Alice, Bob, Carol, Dave, Erin, Grace met", "a zebra here", "Zebra!", None, "",
        "a " * 30 + "b",
    ]
    docs = session.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontaminate.leaks(docs, items).collect()}
    assert found == {(0, 0), (2, 1), (4, 2), (7, 3), (10, 6)}


def test_items_without_blanks_are_found(session):
    """Chinese, Japanese and Thai, whole or with another number, inside longer texts; a shared beginning is none."""
    items = session.createDataFrame(
        [(1, "小明有48个苹果他给了小红12个然后回家吃饭"), (2, "東京タワーの高さは何メートルですか"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "短い")],
        "item_id long, text string",
    )
    docs = [
        "前面的话。小明有48个苹果他给了小红12个然后回家吃饭。后面的话", "开头小明有95个苹果他给了小红31个然后回家吃饭", "小明有一只狗", "質問:東京タワーの高さは何メートルですか?",
        "ก่อน ประเทศไทยมีกี่จังหวัด หลัง", "これは短い文", "東京は大きい", "nothing",
    ]
    table = session.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontaminate.leaks(table, items).collect()}
    assert found == {(0, 1), (1, 1), (3, 2), (4, 3), (5, 4)}


# --- Packing -----------------------------------------------------------------------------------------------------


def test_least_squares_plan_uses_every_piece_once():
    chance = np.random.default_rng(5)
    histogram = np.zeros(65, dtype=np.int64)
    np.add.at(histogram, chance.integers(1, 65, 5000), 1)
    planned = packing.patterns(histogram, 64)
    used = Counter()
    for lengths, n in planned:
        assert sum(lengths) <= 64 and n > 0
        for length in lengths:
            used[length] += n
    assert all(used[k] == histogram[k] for k in range(1, 65))
    windows = sum(n for _, n in planned)
    assert (histogram * np.arange(65)).sum() / (windows * 64) > 0.97


def test_packing_round_trip(session, documents, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for k, t in texts.items()}
    rows = QUERIES["op1_packing"](session, FOLDER).collect()
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_document[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append(row)
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert len(part) == row["length"] and zlib.crc32(part.tobytes()) == row["ids_crc32"]
        assert row["doc_tokens"] == len(ids[row["doc_id"]])
    for k, pieces in by_document.items():
        pieces.sort(key=lambda row: row["start"])
        ends = [0, *(row["start"] + row["length"] for row in pieces)]
        assert [row["start"] for row in pieces] == ends[:-1] and ends[-1] == len(ids[k])
    assert by_document.keys() == ids.keys()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda row: row["offset"])
        ends = [0, *(row["offset"] + row["length"] for row in pieces)]
        assert [row["offset"] for row in pieces] == ends[:-1] and ends[-1] <= 1024
    assert sum(map(len, ids.values())) / (1024 * len(by_sequence)) > 0.95


def test_ids_are_those_of_the_tokenizer_as_it_loads():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a<|endoftext|>b", " <|endoftext|>\n x", "<|endoftext|><|endoftext|>", "<|endoftext|", "<|EndOfText|>", "x" * 5000, " " * 5000]
    odd += ["\ud800 lone", "漢字 \x00 é", "1234567890 " * 400, "a\r\n\t b  ", None, ""]
    for text in odd:
        plain = (text or "").encode("utf-8", "replace").decode()
        assert document_ids(text).tolist() == [*tokenizer.encode(plain, add_special_tokens=False).ids, 0]


def test_a_text_is_tokenized_once(session, documents):
    plan = packing.document_pieces(session, documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_ranks_do_not_depend_on_the_size_of_groups(session):
    pieces = session.createDataFrame([(k, 1 + k % 3) for k in range(3000)], "doc_id long, length long")
    rows = packing.pack(pieces, 8, group_rows=50).collect()
    assert len({(row["sequence_id"], row["offset"]) for row in rows}) == 3000
    filled = Counter()
    for row in rows:
        filled[row["sequence_id"]] += row["length"]
    assert max(filled.values()) <= 8 and sum(filled.values()) == 6000


def test_best_fit_decreasing():
    chance = random.Random(6)
    lengths = [chance.randint(1, 100) for _ in range(500)]
    room, expected = [], []
    for k in sorted(range(500), key=lambda k: -lengths[k]):
        fitting = [(left, row) for row, left in enumerate(room) if left >= lengths[k]]
        if fitting:
            least = min(fitting)[0]
            row = next(row for left, row in fitting if left == least)
            room[row] -= lengths[k]
        else:
            room.append(100 - lengths[k])
    rows = binary_packing.best_fit_decreasing(lengths, 100)
    assert sorted(k for row in rows for k in row) == list(range(500))
    assert sorted(100 - sum(lengths[k] for k in row) for row in rows) == sorted(room)


def test_binary_rows_round_trip(session, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = defaultdict(dict)
    for row in QUERIES["op7_binary_packing"](session, FOLDER).collect():
        ids, positions = np.frombuffer(row["ids"], "<u2"), np.frombuffer(row["position_ids"], "<u2")
        ends = row["cu_seqlens"]
        assert len(ids) == 1024 and ends[0] == 0 and ends[-1] == row["used"] and not ids[row["used"] :].any()
        for doc_id, start, low, high in zip(row["doc_ids"], row["starts"], ends, ends[1:]):
            parts[doc_id][start] = ids[low:high]
            assert (positions[low:high] == np.arange(high - low)).all()
    for k, text in texts.items():
        got = np.concatenate([parts[k][start] for start in sorted(parts[k])]).tolist()
        assert got == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


# --- Licences ----------------------------------------------------------------------------------------------------


def test_licences_against_plain_words(session, texts):
    rows = {row["doc_id"]: row for row in QUERIES["op4_licenses"](session, FOLDER).collect()}
    for k, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = [
            (at, label) for phrase, label in license_scan.BASE for at in range(len(words))
            if words[at : at + len(phrase.split())] == phrase.split()
        ]
        row = rows[k]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((at for at, _ in places), default=None)
        assert row["last_word"] == max((at for at, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}


def test_detections_are_resolved_by_priority_and_containment():
    got = license_scan.scan("Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: GPL-3.0-or-later")
    assert got["labels"] == "apache-2,gpl-3" and [span["kind"] for span in got["spans"]] == ["grant", "tag"]
    assert license_scan.scan("the three-clause BSD license")["labels"] == "bsd-3"
    assert license_scan.scan("GNU Lesser General Public License v2.1")["labels"] == "lgpl-2.1"
    assert license_scan.scan("an article about permits")["labels"] == "" == license_scan.scan(None)["labels"]
    assert sum(len(signatures) for _, signatures in license_scan.RULES) > 300


@pytest.mark.parametrize(
    "label, spellings",
    [
        ("gpl-1", ["GPLv1", "GPL v1"]), ("gpl-2", ["GNU GPLv2", "GNU GPL v2"]), ("gpl-3", ["GNU GPLv3", "GNU GPL v3", "GNU GPL\nv3"]),
        ("lgpl-2", ["LGPLv2", "LGPL v2", "LGPL 2.0"]), ("lgpl-2.1", ["LGPLv2.1", "LGPL v2.1"]), ("lgpl-3", ["LGPLv3", "LGPL v3"]),
        ("agpl-3", ["AGPLv3", "AGPL v3"]), ("mpl-1.1", ["MPLv1.1", "MPL v1.1"]), ("mpl-2", ["MPLv2", "MPL v2", "MPL 2.0"]),
        ("cc-by", ["Creative Commons Attribution 4.0"]),
        ("cc-by-sa", ["Creative Commons Attribution-ShareAlike", "Creative Commons Attribution-Share Alike 4.0"]),
        ("cc-by-nd", ["Creative Commons Attribution No Derivatives", "Creative Commons Attribution-NoDerivs 4.0"]),
        ("cc-by-nc", ["Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0"]),
        ("cc-by-nc-sa", ["Creative Commons Attribution-NonCommercial-ShareAlike", "Creative Commons Attribution NonCommercial Share Alike"]),
        ("cc-by-nc-nd", ["Creative Commons Attribution-NonCommercial-NoDerivs", "Creative Commons Attribution-NonCommercial-No Derivatives"]),
        ("mulan-2", ["Mulan PSL", "Mulan PSLlicense", "Mulan PSL license"]),
    ],
)
def test_optional_blanks_of_licence_names(label, spellings):
    for text in spellings:
        assert license_scan.scan(f"This is under {text}, as said.")["labels"].split(",")[-1] == label, text


def written(parsed, chance):
    """A text that a parsed pattern matches, with white space of any kind."""
    made = []
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            made.append(chr(value))
        elif kind == "BRANCH":
            made.append(written(chance.choice(value[1]), chance))
        elif kind == "SUBPATTERN":
            made.append(written(value[3], chance))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, body = value
            made += [written(body, chance) for _ in range(chance.randint(least, min(int(most), least + 1)))]
        elif kind == "IN":
            first, code = chance.choice(value)
            spaces = [" ", "\n", "\t", "  "]
            made.append({"LITERAL": lambda: chr(code), "RANGE": lambda: chr(chance.randint(*code))}.get(
                str(first), lambda: chance.choice(spaces) if "SPACE" in str(code) and "NOT" not in str(code) else "w")())
        elif kind == "CATEGORY":
            made.append("w")
    return "".join(made)


def test_keywords_are_in_every_match():
    """With and without keywords, the same is detected in texts written after every pattern."""
    chance = random.Random(3)
    tried = 0
    for _, signatures in license_scan.RULES:
        for sign in signatures:
            for _ in range(30):
                text = f"see {written(re._parser.parse(sign.pattern.pattern), chance)} ."
                every = [
                    (match.start(), match.end(), one.priority, one.confidence, one.label, one.kind)
                    for _, others in license_scan.RULES for one in others for match in one.pattern.finditer(text)
                ]
                tried += any(found[4] == sign.label for found in every)
                assert sorted(license_scan.detections(text)) == sorted(every), (sign.label, text)
    assert tried > 10_000


@pytest.mark.parametrize(
    "text, label",
    [
        ("GNU General\nPublic License, version 3", "gpl-3"), ("Creative\nCommons Attribution 4.0", "cc-by"),
        ("released into the public\n  domain", "public-domain"),
        ("Creative Commons Attribution-Non\nCommercial", "cc-by-nc"), ("Creative Commons Attribution-Non-Commercial", "cc-by-nc"),
        ("Creative Commons Attribution-NoDerivatives 4.0", "cc-by-nd"), ("https://www.gnu.org/licenses/fdl", "gfdl-1.3"),
    ],
)
def test_wrapped_licence_names_are_found(text, label):
    assert license_scan.scan(text)["labels"] == label


# --- Neighbours --------------------------------------------------------------------------------------------------


def test_hilbert_curve_visits_neighbouring_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    index = neighbours.hilbert_index(cells, 3)
    assert sorted(index.tolist()) == list(range(512))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("block_rows", [4096, 64])
def test_neighbours_against_brute_force(session, monkeypatch, block_rows):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block_rows)
    chance = np.random.default_rng(7)
    centres = chance.normal(size=(12, 16))
    vectors = centres[chance.integers(0, 12, 600)] + 0.3 * chance.normal(size=(600, 16))
    vectors[100:200] = vectors[100]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] * 16), (1080, [1.0] * 3), (None, rows[0][1])]
    df = session.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for row in sorted(neighbours.nearest(df, lambda k: k % 20 == 0).collect(), key=lambda row: row["rank"]):
        got[row["query_id"]].append((row["vec_id"], row["score"]))
    products = vectors @ vectors.T
    hits = 0
    assert got.keys() == {k for k in range(0, 600, 20)}
    for k, found in got.items():
        others = [j for j in range(600) if j != k]
        best = sorted(others, key=lambda j: (-round(products[k, j], 9), j))[:20]
        assert len(found) == 20 and [score for _, score in found] == pytest.approx([products[k, j] for j, _ in found])
        assert [score for _, score in found] == sorted((score for _, score in found), reverse=True)
        hits += len(set(best) & {j for j, _ in found})
    assert hits / (20 * len(got)) >= (1.0 if block_rows == 4096 else 0.9)


def test_blocks_have_equal_sizes_whatever_the_keys(session):
    """Half of all points share one key of the first curve; they are spread over blocks, in order of the key."""
    chance = random.Random(1)
    rows = [(k, [7 if k % 2 else chance.randrange(100), chance.randrange(1000)]) for k in range(1000)]
    keyed = session.createDataFrame(rows, "point long, keys array<long>").repartition(4)
    found = {row["point"]: row["blocks"] for row in neighbours.blocks_of(keyed, 64).collect()}
    assert len(found) == 1000
    for curve in range(2):
        sizes = Counter(blocks[curve] for blocks in found.values())
        assert sizes == {block: 64 if block < 15 else 40 for block in range(16)}
        in_order = sorted(found, key=lambda k: (found[k][curve], rows[k][1][curve]))
        assert [rows[k][1][curve] for k in in_order] == sorted(keys[curve] for _, keys in rows)


def test_queries_in_chunks_find_the_same(session):
    chance = np.random.default_rng(2)
    rows = [(k, [float(x) for x in chance.normal(size=4)], [k // 50]) for k in range(300)]
    placed = session.createDataFrame(rows, "point long, v array<double>, blocks array<int>")
    asked = session.createDataFrame(rows[::3], placed.schema)
    found = [
        sorted(map(tuple, neighbours.candidates(placed, asked, 1, 1, 6, 5, size).collect())) for size in (1000, 7)
    ]
    looked_at = sum(2 if k // 50 in (0, 5) else 3 for k in range(0, 300, 3))
    assert found[0] == found[1] and len(found[0]) == 5 * looked_at
    best = max((float(np.dot(rows[0][1], rows[j][1])), j) for j in range(100))
    assert max((row[2], row[1]) for row in found[0] if row[0] == 0) == pytest.approx(best)


# --- Quality and URLs --------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(session):
    found = QUERIES["op9_quality"](session, "/root/testdata/sf0.01")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([row["predicted"] == row["quality"] for row in rows]) > 0.95
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)


def test_urls_against_plain_parsing(session):
    rows = QUERIES["op10_urls"](session, FOLDER)
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    addresses = {row["page_id"]: row["url"] for row in session.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for row in rows.collect():
        rest = addresses[row["page_id"]].partition("://")[2]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        fits = []
        for verdict, rule in urls.RULES:
            own, slash, tail = rule.partition("/")
            if (host.lower() == own or host.lower().endswith("." + own)) and path.startswith(slash + tail):
                fits.append((len(rule), rule, verdict))
        assert (row["host"], row["path"]) == (host.lower(), path)
        assert row["rule"] == (max(fits)[1] if fits else None)
        assert row["verdict"] in ("allow", "block") and (not fits or row["verdict"] == max(fits)[2])


def test_odd_urls(session):
    odd = [(1, None), (2, "no scheme/here"), (3, "HTTP://A.Example.NET?x=1"), (4, "x://example.net/en/?q"), (5, "a://b://c/d"), (6, "://"), (7, "")]
    got = {row["page_id"]: row for row in urls.verdicts(session.createDataFrame(odd, "page_id long, url string")).collect()}
    assert [(got[k]["host"], got[k]["path"]) for k in range(1, 8)] == [
        ("", ""), ("", ""), ("a.example.net", ""), ("example.net", "/en/"), ("b:", "//c/d"), ("", ""), ("", ""),
    ]
    assert got[3]["rule"] is None and got[4]["rule"] == "example.net/en/" and got[4]["verdict"] == "allow"


def labelled_urls(spark, seed, tell):
    """URLs of three suffixes; ``tell`` says which are blocked, and half of each suffix has a label."""
    chance = random.Random(seed)
    rows = []
    for k in range(1500):
        host = f"{chance.choice(['a', 'b-c', 'www'])}.{chance.choice(['one', 'two', 'three'])}.com"
        spam = chance.random() < 0.5
        path = "/".join(chance.choice(["news", "page", "about"]) for _ in range(chance.randint(1, 3)))
        tail = "?" + "&".join(f"p{n}={chance.randint(0, 10**9)}" for n in range(chance.randint(3, 6))) if spam else ""
        url = f"http://{host}/{path}{tail}"
        rows.append((k, url, host, f"/{path}", int(tell(host, spam)) if k % 2 else None, int(tell(host, spam))))
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, known int, truth int")


def test_url_trees_use_more_than_the_suffix(session):
    """Where what blocks is the parameters, URLs of one suffix get different verdicts, by lexical features."""
    table = labelled_urls(session, 3, lambda host, spam: spam)
    judged = urls.judge(table, "url", F.col("known")).where("known IS NULL").collect()
    assert np.mean([row["blocked"] == row["truth"] for row in judged]) > 0.97
    for suffix in ("one.com", "two.com", "three.com"):
        assert {row["blocked"] for row in judged if row["host"].endswith(suffix)} == {0.0, 1.0}
    right, importance = urls.held_out(table, "url", F.col("known"))
    assert right > 0.97 and importance["f_blocked"] + importance["f_common"] < 0.3 and sum(importance.values()) == pytest.approx(1)


def test_url_trees_use_the_suffix_where_it_tells(session):
    table = labelled_urls(session, 4, lambda host, spam: host.endswith("two.com"))
    judged = urls.judge(table, "url", F.col("known")).where("known IS NULL").collect()
    assert np.mean([row["blocked"] == row["truth"] for row in judged]) > 0.97
    right, importance = urls.held_out(table, "url", F.col("known"))
    assert right > 0.97 and max(importance, key=importance.get) in ("f_blocked", "f_common")


def test_suffix_statistics_leave_the_own_fold_out(session):
    chance = random.Random(9)
    rows = [(chance.choice("xyz"), chance.randrange(urls.FOLDS), chance.choice([None, 0, 1])) for _ in range(400)]
    got = {(r["suffix"], r["fold"]): r for r in urls.suffix_statistics(session.createDataFrame(rows, "suffix string, fold int, label int")).collect()}
    known = [label for *_, label in rows if label is not None]
    base = (sum(known) + 0.5) / (len(known) + 1)
    for (suffix, fold), row in got.items():
        others = [label for s, f, label in rows if s == suffix and f != fold]
        blocked = sum(label if label is not None else base for label in others) + urls.PRIOR * base
        assert row["f_blocked"] == pytest.approx(blocked / (len(others) + urls.PRIOR))
        assert row["f_common"] == pytest.approx(np.log1p(sum(s == suffix for s, *_ in rows)))


# --- Fixes of single parts ---------------------------------------------------------------------------------------


def plainly_resolved(found):
    """Detections kept, looked at against all that were kept before."""
    kept = []
    for one in sorted(found, key=lambda d: (-d[2], d[0] - d[1], d[0], d[4])):
        if not any((o[0] <= one[0] and one[1] <= o[1]) or (one[0] < o[1] and o[0] < one[1] and o[2] > one[2]) for o in kept):
            kept.append(one)
    return sorted(kept)


def test_detections_are_resolved_as_by_the_plain_definition():
    chance = random.Random(2)
    for size in (0, 1, 5, 60, 300):
        found = []
        for _ in range(size):
            start = chance.randrange(3 * size)
            found.append((start, start + chance.randint(1, 12), chance.randint(1, 4), 0.5, chance.choice("abc"), "k"))
        found = list(dict.fromkeys(found))
        assert license_scan.resolved(found) == plainly_resolved(found)


def test_many_mentions_are_resolved_quickly():
    text = "x licensed under the GNU General Public License, version 3. " * 16_000
    start = time.perf_counter()
    found = license_scan.detections(text.lower())
    middle = time.perf_counter()
    assert len(license_scan.resolved(found)) == 16_000
    assert time.perf_counter() - middle < max(1.0, middle - start)


@pytest.mark.parametrize(
    "text, label",
    [
        ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software", "mit"),
        ("Redistribution and use in source and binary forms, with or without\n modification, are permitted", "bsd"),
        ("Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products", "bsd-3"),
        ("All advertising materials mentioning features or use of this software must display", "bsd-4"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above", "isc"),
        ('Licensed under the Apache License, Version 2.0 (the "License")', "apache-2"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
        ("GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gpl-3"),
        ("the GNU General Public License, as we said, either version 2 of the License", "gpl-2"),
        ("under the terms of the GNU Lesser General Public License; either version 2.1 of the License", "lgpl-2.1"),
        ("the GNU Affero General Public License as published, either version 3 of the License", "agpl-3"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
        ("accompanying materials are made available under the terms of the Eclipse Public License 2.0", "epl-2"),
        ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable", "zlib"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", "bsl-1"),
        ("This is free and unencumbered software released into the public domain", "unlicense"),
        ("To the extent possible under law, the author has waived all copyright and related or neighboring rights", "cc0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("BSD 3-Clause License", "bsd-3"),
        ("it is Apache-2.0 here", "apache-2"),
        ("GPL-3.0", "gpl-3"),
        ("GPL version 3", "gpl-3"),
        ("version 2 of the GPL", "gpl-2"),
        ("Licensed under Apache 2.0", "apache-2"),
        ("released under mit.", "mit"),
    ],
)
def test_texts_versions_and_identifiers(text, label):
    assert label in license_scan.scan(text)["labels"].split(",")


def test_denied_grants_are_none():
    for text in ("this is not licensed under the ISC license", "It is no longer released under the terms of the GPL version 2"):
        found = license_scan.scan(text)
        assert (found["labels"], found["score"], found["spans"]) == ("", 0.0, [])
    assert license_scan.scan("not so good, but licensed under the ISC license")["labels"] == "isc"


def test_pairs_of_numbers_with_few_values():
    chance = np.random.default_rng(6)
    for x in (chance.integers(0, 2, (4000, 3)).astype(float), chance.random((4000, 3)), chance.integers(0, 4, (4000, 3)) / 3.0):
        labels = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
        model = quality.fit(x[:3000], labels[:3000])
        assert np.mean((model.score(x[3000:]) >= 0.5) == labels[3000:]) > 0.95


def test_boosting_against_a_naive_loop():
    """The first turns of the boosting, value by value."""
    chance = np.random.default_rng(8)
    x = chance.integers(0, 3, (60, 2)).astype(float)
    labels = (x[:, 0] + chance.random(60) > 1.4).astype(float)
    edges = [quality.inner_edges(column, quality.BINS) for column in x.T]
    share = (labels.sum() + 0.5) / 61
    logits = [math.log(share / (1 - share))] * 60
    tables = [[0.0] * 3 for _ in range(2)]

    def leaf(bins, slopes, weights):
        return sum(slopes[b] for b in bins) / (sum(weights[b] for b in bins) + quality.RIDGE)

    def gain(bins, slopes, weights):
        return sum(slopes[b] for b in bins) ** 2 / (sum(weights[b] for b in bins) + quality.RIDGE)

    def grow(bins, slopes, weights, depth):
        options = [(gain(bins[:k], slopes, weights) + gain(bins[k:], slopes, weights) - gain(bins, slopes, weights), -k) for k in range(1, len(bins))]
        # Bins beyond those in use hold nothing: a cut there gains nothing.
        if depth and options and max(options)[0] > 1e-12:
            k = -max(options)[1]
            return grow(bins[:k], slopes, weights, depth - 1) + grow(bins[k:], slopes, weights, depth - 1)
        return [leaf(bins, slopes, weights)] * len(bins)

    for _ in range(quality.ROUNDS):
        for k in range(2):
            p = [1 / (1 + math.exp(-v)) for v in logits]
            slopes, weights = [0.0] * 3, [0.0] * 3
            for row, label, share in zip(x, labels, p):
                slopes[int(row[k])] += label - share
                weights[int(row[k])] += share * (1 - share)
            step = [quality.RATE * v for v in grow([0, 1, 2], slopes, weights, 2)]
            tables[k] = [a + b for a, b in zip(tables[k], step)]
            logits = [v + step[int(row[k])] for v, row in zip(logits, x)]
    model = quality.fit(x, labels)
    assert [len(own) for own in edges] == [2, 2]
    for k in range(2):
        assert np.allclose(model.tables[k][:3], tables[k], atol=1e-9)


def test_a_repeated_id_is_one_row_of_a_sample(session):
    documents = session.createDataFrame([(1, f"t{k}") for k in range(500)] + [(2, "u"), (3, None)], "doc_id long, text string")
    labels = session.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    found = sorted(map(tuple, labelled_sample(documents, labels, "toxic", 100).collect()))
    assert found == [(1, "t99", 1), (2, "u", 0), (3, "", 1)]


def test_words_of_any_length_are_searched_whole():
    model = language(["winter", "house", "garden", "summer", "good"] * 50)
    filler = "garden" * 12
    for gap in range(60, 70):
        word = (filler * 2)[:gap] + "w1nt3r"
        assert toxicity.restore(word, model).endswith("winter")
    run = " ".join("summer" * 15) + " w i n t e r"
    assert "winter" in "".join(toxicity.spaced_words(run, model))
