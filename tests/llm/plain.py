"""Plain Python versions of the operators, for small tables, and a table with awkward rows."""

import hashlib
import re
from collections import Counter

LOWER = {i: i + 32 for i in range(65, 91)}
SHINGLE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brews of bright green wine and sing to passing ships"


def near_duplicates(rows):
    """{doc_id: (n_shingles, component)} for rows (doc_id, text) with distinct ids."""
    sets = {}
    for d, t in rows:
        w = SHINGLE_WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    at, shared = {}, Counter()
    for d, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(d)
    for docs in at.values():
        shared.update((a, b) for i, b in enumerate(docs) for a in docs[:i])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def kept_bytes(rows, length=50):
    """(doc_id, text bytes, kept bytes, number of removed runs) of each row."""
    texts, first, out = [(d, (t or "").encode()) for d, t in rows], {}, []
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - length + 1):
                first[b[i : i + length]] = min(d, first.get(b[i : i + length], d))
    for d, b in texts:
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < d:
                    gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, b, bytes(x for x, g in zip(b, gone) if not g), runs))
    return out


def personal_data(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def license_places(text):
    """(number of words, sorted starts, labels) of the phrases."""
    words, starts, labels = WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), sorted(starts), sorted(labels)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: doc_id and text: null, empty, blank, short and very long texts, copies, near copies, repeated rows, a null id, other scripts.
ROWS = [
    (1, SENTENCE),
    (2, SENTENCE),
    (3, SENTENCE.replace("ships", "boats")),
    (4, SENTENCE.upper()),
    (5, None),
    (6, ""),
    (7, " \t\n "),
    (8, "one two three"),
    (9, "one two three"),
    (10, "idiot " * 3 + "über Straße 漢字 😀 naïve café　end"),
    (11, " ".join(f"w{i}" for i in range(30_000))),
    (12, " ".join(f"w{i}" for i in range(5, 30_000))),
    (13, "Mail ann@example.org or 10.0.0.1 or 4111 1111 1111 1111 or +1 (234) 555-6789. " + SENTENCE),
    (14, "!" * 400),
    (15, "!" * 300 + SENTENCE),
    (16, "Released under the MIT License. mit license, GNU General Public License"),
    (16, "Released under the MIT License. mit license, GNU General Public License"),
    (17, "é" * 60 + "x"),
    (18, "zz" + "é" * 60),
    (None, SENTENCE),
    (None, "Apache License"),
]
NAMES = "doc_id long, text string, lang string, source string, n_chars long"
#: Further columns under names that the operators use themselves.
CLASHES = ("key", "node", "n", "token", "group", "row", "at", "score", "predicted", "shard", "kept", "spans", "terms", "toxic", "piece", "rep", "size")


def documents(spark, rows=ROWS, clashes=True):
    df = spark.createDataFrame([(d, t, "en" if d else None, None, len(t) if t is not None else None) for d, t in rows], NAMES)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES}).withColumn("Odd name.", F.lit(None).cast("string"))
    return df
