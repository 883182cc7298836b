"""Line and document dedup, decontamination and the pipeline against loops on small tables."""

import os
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tillwork.llm import line_hashing, positional_index, template_tree, vertical_join
from tillwork.llm import components as components_module
from tillwork.llm.components import components
from tillwork.session import shared_root

WORDS = [f"w{k}" for k in range(400)]


def clashing(corpus, *rows):
    extra = {c: F.lit(1) for c in ("key", "class", "gram", "line_no", "template", "row", "start", "label", "bad", "gone")}
    return corpus(*rows).withColumns(extra)


def varied(rng, words, share):
    return [rng.choice(WORDS) + "x" if rng.random() < share else w for w in words]


def near_copies(seed=3, groups=6):
    """Groups of near copies, exact copies, passages that many share, and odd texts."""
    rng, rows = random.Random(seed), []
    passage = " ".join(rng.choices(WORDS, k=30))
    for _ in range(groups):
        base = rng.choices(WORDS, k=rng.randrange(40, 160))
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05):
            rows.append(" ".join(varied(rng, base, share)))
        rows.append(" ".join(rng.choices(WORDS, k=60)) + "\n" + passage)
    rows += [None, "", "one two", "One  TWO", "one two three", "a b c d e", "a b c d e", " \n"]
    ids = list(range(10, 10 + len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def reached(rows):
    sets = {k: shingles(t) for k, t in rows}
    label = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_join_against_all_pairs(corpus):
    rows = near_copies()
    sets, label = reached(rows)
    got = vertical_join.join(clashing(corpus, *rows)).collect()
    assert {r.key.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        k: (len(sets[k]), label[k]) for k in sets
    }
    kept = vertical_join.one_of_each(clashing(corpus, *rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k in label if label[k] == k)


def test_links_do_not_depend_on_the_number_of_fragment_groups(corpus, monkeypatch):
    rows = near_copies(5, 2)
    _, label = reached(rows)
    monkeypatch.setattr(vertical_join, "SLAB", 8)
    got = vertical_join.join(corpus(*rows)).collect()
    assert {r.key.doc_id: r.component_id for r in got} == label


def test_join_of_one_large_group_stays_linear(corpus):
    rng = random.Random(9)
    base = rng.choices(WORDS, k=120)
    rows = [(k, " ".join(varied(rng, base, 0.04 if k else 0))) for k in range(60)]
    _, label = reached(rows)
    got = vertical_join.join(corpus(*rows)).collect()
    assert {r.key.doc_id: r.component_id for r in got} == label


def test_join_edges(corpus):
    assert vertical_join.join(corpus((1, "a")).where("false")).count() == 0
    got = vertical_join.join(corpus((None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, None))).collect()
    assert sorted((r.key.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 2, 4), (4, 2, 4), (4, 2, 4),
    ]


def test_components_of_chains_and_stars(spark, monkeypatch):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 30)] + [(103, 103), (None, 5)]
    links = spark.createDataFrame([*chain, *star, (7, 6)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}
    monkeypatch.setattr(components_module, "MANY", 0)
    before = set(os.listdir(shared_root(spark)))
    assert {r.node: r.label for r in components(links).collect()} == got
    kept = set(os.listdir(shared_root(spark))) - before
    assert len(kept) == 1 and kept.pop().startswith("links-")
    assert components(links.where("false")).count() == 0


def windows(items, size=13):
    out = {}
    for name, text in items:
        w = re.findall(positional_index.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        for i in range(max(len(w) - size + 1, 1 if w else 0)):
            out.setdefault(tuple(w[i : i + size]), set()).add(str(name))
    return out


def test_decontamination_against_a_loop(spark, corpus):
    rng = random.Random(4)
    item = rng.choices(WORDS, k=30)
    same = ["so"] * 14
    items = [(1, " ".join(item)), (2, "tiny item"), (3, None), (10, " ".join(item[5:25])), (11, " ".join(same)), (None, "tiny item")]
    texts = [
        " ".join(rng.choices(WORDS, k=50) + item[3:20] + rng.choices(WORDS, k=20)),
        " ".join(item).upper() + ", É tiny; item!",
        "tiny  item tiny item",
        " ".join(same * 2),
        " ".join(item[:12]),
        None,
        "",
        " ".join(rng.choices(WORDS, k=400) + item[:13]),
    ]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, "tiny item"), (2, "tiny  item tiny item"), (2, "other text")]
    held = windows([i for i in items if i[0] is not None])
    every = windows(items)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = positional_index.contamination(clashing(corpus, *docs), table.withColumn("term", F.lit("x"))).collect()
    assert len(got) == len(docs)
    for name, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w, hit, found = re.findall(positional_index.WORD, lower), set(), set()
        for size in {len(x) for x in every}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in every:
                    hit |= set(range(i, i + size))
                    found |= held.get(tuple(w[i : i + size]), set())
        want = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
        assert want in [
            (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got if r.key.doc_id == name
        ]
    clean = positional_index.without_contaminated(clashing(corpus, *docs), table)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 4, 5, 6, 7]
    assert positional_index.contamination(corpus(*docs), table.where("false")).where("contaminated").isEmpty()
    assert positional_index.contamination(corpus(*docs).where("false"), table).isEmpty()


def test_proximity_matches(spark, corpus):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = corpus((1, "x alpha beta noise gamma delta"), (2, "alpha beta gamma delta"), (3, "alpha y delta"))

    def found(**options):
        rows, _, _ = positional_index.matches(docs, items, **options)
        return sorted(r.key.doc_id for r in rows.select("key").distinct().collect())

    assert found() == [2]
    assert found(slop=1, least=0.75) == [1, 2]


def test_proximity_without_the_rarest_word(spark, corpus):
    passage = [f"p{k}" for k in range(13)]
    items = spark.createDataFrame([(1, " ".join(passage)), (2, "absent " + " ".join(f"q{k}" for k in range(12)))], "item_id long, text string")
    edited = [*passage[:6], "other", *passage[7:]]
    docs = corpus(
        (1, " ".join(["x", *edited, "y"])),
        (2, " ".join(passage)),
        (3, " ".join(passage[1:])),
        (4, "common " + " ".join(f"q{k}" for k in range(12))),
        (5, " ".join([*edited[:9], "else", *edited[10:]])),
        *((10 + k, " ".join(w for w in passage if w != "p6")) for k in range(2)),
        (20, None),
    )
    got = {r.key.doc_id: (r.n_exact, r.n_near) for r in positional_index.hits(docs, items, slop=0).collect()}
    assert [got[k] for k in (1, 2, 3, 4, 5, 20)] == [(0, 1), (1, 1), (0, 1), (0, 1), (0, 0), (0, 0)]
    near, _, _ = positional_index.matches(corpus((1, " ".join(["p6", *edited[:6], *edited[7:]]))), items, slop=1, least=0.9)
    assert near.count() > 0


def test_plan_of_decontamination_has_no_python(spark, corpus):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    plan = positional_index.contamination(corpus((1, "alpha beta")), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_template_lines(corpus):
    def page(k, rest):
        return f"User {k} logged in from host{k} today at noon\n{rest}\n\nAll rights reserved."

    docs = [(k, page(k, f"{'y' * k} stands here by itself")) for k in range(1, 6)]
    docs += [(6, None), (7, ""), (8, "User 1 was never seen here at all"), (9, page(1, "own"))]
    got = {r.doc_id: r for r in template_tree.cleaned(clashing(corpus, *docs)).collect()}
    assert got[1].text == docs[0][1] and got[1].n_dropped == 0
    for k in range(2, 6):
        assert got[k].text == f"{'y' * k} stands here by itself\n" and got[k].n_dropped == 2
    assert got[9].text == "own\n" and got[6].text is None and got[7].text == ""
    assert got[8].n_dropped == 0 and [got[6].n_lines, got[7].n_lines] == [0, 1]
    whole = template_tree.replace_text(clashing(corpus, *docs))
    assert whole.columns == clashing(corpus, *docs).columns and whole.count() == len(docs)
    assert template_tree.cleaned(corpus(*docs).where("false")).count() == 0


def test_templates_generalise_variable_words(corpus):
    names = ["anna", "bob", "carl", "dora", "emil"]
    docs = [(k, f"dear customer we thank {n} for the order of last week") for k, n in enumerate(names)]
    got = {r.doc_id: r.n_dropped for r in template_tree.cleaned(corpus(*docs)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1}


def test_all_templates_of_a_leaf_are_found(corpus):
    forms = [
        "we are glad that {} came to our small shop today",
        "we are glad with every order of {} sent by mail",
        "we are glad because new {} items were found last week",
        "we are glad if your {} car was repaired without delay",
    ]
    names = ["anna", "bob", "carl"]
    docs = [(10 * k + j, form.format(n)) for k, form in enumerate(forms) for j, n in enumerate(names)]
    got = {r.doc_id: r.n_dropped for r in template_tree.cleaned(corpus(*docs)).collect()}
    assert sum(got.values()) == 8


def test_fields_do_not_count_against_a_template(corpus):
    names = ["alice", "bob", "carol"]
    docs = [(k, f"2024-01-0{k + 5} 12:0{k}:44 [4{k}] user {n} logged in id=7{k}") for k, n in enumerate(names)]
    got = {r.doc_id: r.n_dropped for r in template_tree.cleaned(corpus(*docs)).collect()}
    assert got == {0: 0, 1: 1, 2: 1}


def test_lines_that_share_their_path_alone_stay(corpus):
    docs = [(k, f"My name is {n}") for k, n in enumerate(["Anna", "Bob", "Eve"])]
    docs += [(10 + k, "My name is Legion") for k in range(3)]
    got = {r.doc_id: r.n_dropped for r in template_tree.cleaned(corpus(*docs)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 10: 0, 11: 1, 12: 1}


def template_lines_kept(docs, min_docs=3):
    """Lines that stay when only equal lines recur: the first of each that ``min_docs`` documents have."""
    holders, out = {}, {}
    for name, text in docs:
        for line in (text or "").split("\n"):
            if line.split():
                holders.setdefault(tuple(line.split()), []).append(name)
    first = {k: min(v) for k, v in holders.items() if len(set(v)) >= min_docs}
    for name, text in docs:
        kept, seen = [], set()
        for line in (text or "").split("\n"):
            tokens = tuple(line.split())
            if tokens in first and (first[tokens] != name or tokens in seen):
                continue
            seen.add(tokens)
            kept.append(line)
        out[name] = "\n".join(kept)
    return out


def test_lines_that_recur_against_a_loop(corpus):
    """Lines of one leaf each: what recurs goes, but for its first occurrence."""
    rng = random.Random(12)
    spelt = str.maketrans("0123456789", "abcdefghij")  # tokens with digits are fields
    pool = [" ".join([f"head{k}", *(f"tail{k}y{j}" for j in range(4 + k % 3))]) for k in range(30)]
    docs = [(k, "\n".join(rng.choices(pool, k=3) + [f"own{k} line{k} of{k} doc{k} here{k}"])) for k in range(60)]
    docs = [(k, t.translate(spelt)) for k, t in docs]
    docs += [(90, ""), (92, "own line that nobody else has at all " * 2000)]
    got = {r.doc_id: r.text for r in template_tree.replace_text(clashing(corpus, *docs)).collect()}
    assert got == template_lines_kept(docs)


def test_template_edges(corpus):
    """Repeated rows, null ids, null texts and long texts have a result each."""
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "x " * 100_000)]
    got = template_tree.replace_text(clashing(corpus, *docs))
    assert got.count() == 5 and got.columns == clashing(corpus, *docs).columns
    assert {r.doc_id: len(r.text or "") for r in got.where("doc_id = 2").collect()} == {2: 200_000}
    assert template_tree.replace_text(corpus((1, "a")).where("false")).count() == 0


def test_repeated_lines_keep_the_earliest(corpus):
    long_line = " ".join(f"Word{k}," for k in range(30))
    docs = [
        (5, f"intro\n{long_line}\nend"),
        (2, long_line.upper().replace(",", " ;")),
        (9, f"é {long_line}x\n{long_line}"),
        (9, f"é {long_line}x\n{long_line}"),
        (7, None),
        (8, "short\nshort"),
    ]
    got = line_hashing.repeated_units(clashing(corpus, *docs)).collect()
    texts = dict(docs)
    assert sorted((r.doc_id, r.kept_doc_id) for r in got) == [(5, 2), (9, 2), (9, 2), (9, 9)]
    assert all(texts[r.doc_id][r.start : r.end] in (long_line, f"é {long_line}x") for r in got)
    removed = line_hashing.repeated_units(corpus(*docs[:2]))
    cut = {r.doc_id: r.text for r in line_hashing.without_units(corpus(*docs[:2]), removed).collect()}
    assert cut == {5: "intro\nend", 2: docs[1][1]}
    assert line_hashing.repeated_units(corpus(*docs).where("false")).count() == 0


def test_repeated_passages_in_short_lines_and_inside_lines(corpus):
    words = [f"word{k}" for k in range(60)]
    short = "\n".join(" ".join(words[k : k + 6]) for k in range(0, 60, 6))
    wrapped = "\n".join(" ".join(words[k : k + 10]) for k in range(0, 60, 10))
    said = " ".join(words[:14]) + ". " + " ".join(words[14:30]) + "."
    common = [f"Common line {k}" for k in range(12)]
    docs = [
        (1, f"own one\n\n{short}\n\nend one"),
        (2, f"own two\n{short}\nend two"),
        (3, f"own three\n\n{wrapped}\n\nend three"),
        (4, f"First here. {said} Last here."),
        (5, f"Another begin. {said} Another end."),
        *((20 + k, f"before {k}\n{line}\nafter {k}") for k, line in enumerate(common)),
        (40, "\n".join(common)),
    ]
    removed = line_hashing.repeated_units(corpus(*docs))
    cut = {r.doc_id: r.text for r in line_hashing.without_units(corpus(*docs), removed).collect()}
    assert cut[2] == "own two\nend two" and cut[3] == "own three\n\n\nend three"
    assert cut[5] == "Another begin. Another end."
    assert all(cut[k] == text for k, text in docs if k not in (2, 3, 5))


def test_repeated_rows_and_null_ids_are_cut_each_by_itself(corpus):
    lines = [" ".join(f"{name}{k}" for k in range(30)) for name in "abc"]
    docs = [
        *[(9, f"one\n{lines[0]}")] * 3,
        (9, f"two\n{lines[0]}"),
        (None, f"three\n{lines[1]}"),
        (None, f"four\n{lines[1]}"),
        *[(None, f"five\n{lines[2]}")] * 2,
        (None, None),
        (12, f"six\n{lines[1]}\nend"),
    ]
    table = clashing(corpus, *docs).repartition(3)
    cut = line_hashing.without_units(table, line_hashing.repeated_units(table)).collect()
    assert len(cut) == len(docs)
    for line in lines:
        assert sum((r.text or "").count(line) for r in cut) == 1
    assert sorted(r.text for r in cut if r.doc_id == 12) == ["six\nend"]
    assert [sum(r.text == "" for r in cut if r.doc_id == k) for k in (9, None)] == [2, 1]
    assert sum(r.text in ("three\n", "four\n") for r in cut) == 1


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(2)
    stop = "the of and to in is that with".split()

    def prose(n):
        return " ".join(w for k in range(n) for w in (rng.choice(WORDS).replace("w", "word"), stop[k % 8]))

    base, item = prose(60), prose(20)
    rows = [
        (1, base), (2, base), (3, base + " the end"), (4, "### " * 90), (5, prose(50) + " " + item),
        (6, prose(80)), (7, None), (8, prose(70) + "\nContact the editor of page 1"),
        (9, prose(70) + "\nContact the editor of page 2"), (10, prose(70) + "\nContact the editor of page 3"),
    ]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, at = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        at[name] = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert at["quality_rules"] == at["line_dedup"] == [1, 2, 3, 5, 6, 8, 9, 10]
    assert at["ngram_jaccard_join"] == [1, 5, 6, 8, 9, 10]
    assert at["decontamination"] == [1, 6, 8, 9, 10]
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert "page 1" in texts[8] and "page" not in texts[9] + texts[10]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(texts)
