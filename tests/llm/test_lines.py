import random

from pageloom.llm import lines


def close(a, b):
    """Edit distance of two lines is at most 1, by characters."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def normal(line):
    return " ".join(w.decode() for w in line.encode().split())  # of bytes: ASCII white space only


def brute(docs):
    """Each line against all earlier ones."""
    seen, out = [], {}
    for i, text in sorted((d for d in docs if d[1] is not None), key=lambda d: (d[0] is None, d[0])):
        kept = []
        for line in text.split("\n"):
            n = normal(line)
            if n and any(close(n, s) for s in seen):
                seen.append(n)
                continue
            if n:
                seen.append(n)
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


def deduplicated(spark, docs):
    return lines.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()


def test_lines_equal_all_pairs(spark):
    rng = random.Random(11)
    letters = ["a", "b", " ", "é", "中", "\U0001f600", "\x1c", "　"]
    sizes = [0, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 34, 63, 64, 65, 100, 127, 128, 200, 513, 600]
    base = ["".join(rng.choice(letters) for _ in range(n)) for n in sizes]

    def edited():
        line = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            kind, at = rng.choice("adc"), rng.choice([0, len(line) // 2, max(len(line) - 1, 0), rng.randint(0, max(len(line) - 1, 0))])
            if kind == "a":
                line.insert(at + rng.randint(0, 1), rng.choice(letters))
            elif line and kind == "d":
                line.pop(at)
            elif line:
                line[at] = rng.choice(letters)
        line = "".join(line)
        return rng.choice(["", " ", "\t"]) + (line.replace(" ", rng.choice([" ", "  ", "\t", " \r"]))) + rng.choice(["", " ", "\r"])

    docs = [(i, "\n".join(edited() for _ in range(rng.randint(0, 9)))) for i in rng.sample(range(1000), 90)]
    docs += [(5000, None), (5001, ""), (5002, "\n\n"), (5003, "only " * 5000 + "once")]
    rows, want = deduplicated(spark, docs), brute(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.row.text == want.get(r.row.doc_id), r.row.doc_id
        if r.row.text is not None:
            assert r.lines == len(dict(docs)[r.row.doc_id].split("\n"))
            assert r.kept_lines == (r.row.text.count("\n") + 1 if r.kept_lines else 0)


def test_one_edit_at_every_place(spark):
    """A line of each size with one edit at each place goes; two edits stay."""
    docs, gone = [], []
    for n in [1, 2, 3, 6, 16, 17, 32, 33, 34, 70]:
        line = "".join(chr(0x4e00 + 100 * n + i) for i in range(n))
        docs.append((len(docs), line))
        for at in range(n + 1):
            for other in (line[:at] + "x" + line[at:], line[:at] + "y" + line[at + 1:], line[:at] + line[at + 1:]):
                gone.append(len(docs))
                docs.append((len(docs), other))
    docs = [d for d in docs if d[1]]
    want = brute(docs)
    assert all(want[i] == "" for i in gone if i in want)
    assert {r.row.doc_id: r.row.text for r in deduplicated(spark, docs)} == want


def test_very_long_lines(spark):
    """Several rounds of cutting; an added space and one changed character at 300,000 go, two changes stay."""
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh ") for _ in range(300_000)).strip().replace("  ", "c ")
    line = " ".join(line.split())
    added = line[:7] + ("z" if line[7] != "z" else "y") + line[7:]
    changed = line[:150_000] + "é" + line[150_001:]
    twice = "Ω" + line[1:299_000] + "Ω" + line[299_001:]
    docs = [(1, line), (2, added), (3, changed), (4, twice), (5, line + "q"), (6, line)]
    got = {r.row.doc_id: r.row.text for r in deduplicated(spark, docs)}
    assert got == {1: line, 2: "", 3: "", 4: twice, 5: "", 6: ""}


def test_hot_line_and_hot_variant(spark):
    shared = " ".join(f"s{i}" for i in range(9))
    docs = [(i, f"{shared}\n{shared}{chr(0x5000 + i)}\nown line number {'x' * i}") for i in range(0, 600, 2)]
    rows = {r.row.doc_id: r.row.text for r in deduplicated(spark, docs)}
    assert rows[0] == f"{shared}\nown line number "  # the second line has one character more than the first
    assert all(rows[i] == f"own line number {'x' * i}" for i in range(2, 600, 2))


def test_odd_tables(spark):
    schema = "doc_id bigint, text string, at string, words int, row string, id int, hash int, k0 int, size int, part int"
    assert lines.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    line = "one two three four five six seven eight nine"
    rows = [(None, line, "x", 1, "r", 1, 1, 1, 1, 1), (2, line, "y", 2, "r", 1, 1, 1, 1, 1), (2, line, "y", 2, "r", 1, 1, 1, 1, 1)]
    got = lines.dedup_lines(spark.createDataFrame(rows, schema)).select("row.*").collect()
    assert sorted((r.doc_id or 99, r.text, r.at, r.words) for r in got) == [(2, line, "y", 2), (2, line, "y", 2), (99, "", "x", 1)]


def test_spaces_and_words(spark):
    """A space more is one edit, a whole word changed is not, at any length."""
    long = "one two three four five six seven eight nine ten"
    docs = [(1, long), (2, long.replace("fi", "f i")), (3, long.replace("five", "seventy")), (4, "a word"), (5, "aword"), (6, "two words"), (7, "two birds")]
    got = {r.row.doc_id: r.row.text for r in deduplicated(spark, docs)}
    assert got == {1: long, 2: "", 3: docs[2][1], 4: "a word", 5: "", 6: "two words", 7: "two birds"}
