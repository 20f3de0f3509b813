"""Personal data: patterns, and terms that give a protected entity away.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers. Their values are the protected entities. How much a term reveals of an entity is estimated from the whole
corpus: with document counts of entity, term and both, the pointwise mutual information log(n_both * N / (n_entity * (n_term + 1/2))) is compared with the information content of the entity,
log(N / n_entity). The half document without the entity smooths the estimate: of the few words of a table of twenty documents most stand only once, and that reveals little. A term that reveals more than a threshold's part of it is disclosing and is generalised,
like the entity itself, in the documents that hold an entity; ``everywhere`` generalises it in all documents, also where nothing is protected. Nothing else is asked of a term: of an
entity in one document, the words that hardly any other document has are disclosing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import bit_table, columns, stored
from tasador.llm.text import LOWER, NOT_WORD, hash_spans, pieces, spans, utf8

#: Kinds in their order, and what replaces each.
KINDS = ("email", "ip", "card", "phone")
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
#: A term discloses an entity if it reveals this part of its information.
DISCLOSED = 0.9
#: Documents without the entity that smooth a term's count.
SMOOTH = 0.5
#: Entities and terms in more than this part of all documents are few, and are joined by broadcast.
OFTEN = 1 / 200
#: Bits at most of the table that keeps the search for places to disclosing terms; a full table only means more searching.
TABLE = 1 << 27
#: Bytes of text read at once: places are kept in bytes and code points, in some hundred bytes for each byte.
READ = 512 << 10

# fixed values: the patterns; the look-behinds only save repeated attempts inside a run of digits
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """The check sum of card numbers: every second digit from the right doubled."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    """Addresses, found from their @ so that the time is linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _value(kind: str, raw: str) -> str:
    return f"{kind}:{raw.lower() if kind == 'email' else ''.join(_DIGIT.findall(raw)) if kind != 'ip' else raw}"


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_SPAN_SQL = "array<struct<kind: string, start: int, end: int>>"


def _hashes(words: list[str]) -> np.ndarray:
    data, bounds = utf8(pa.array(words, pa.string()))
    return hash_spans(LOWER[data], bounds[:-1], bounds[1:]).view(np.int64)


def _read(piece: pa.RecordBatch):
    """Spans of the entities of each text, and all words that are no part of one: hashes, rows, starts and ends in code points."""
    texts = piece.column("text").to_pylist()
    found = [entities(text) if text else [] for text in texts]
    data, bounds = utf8(piece.column("text"))
    first = (data[: bounds[-1]] & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(first)])
    byte = np.append(np.flatnonzero(first), bounds[-1])
    taken = np.zeros(bounds[-1] + 1, np.int64)
    for row in (i for i, f in enumerate(found) if f):
        for _, a, b in found[row]:
            a, b = byte[before[bounds[row]] + np.array([a, b])]
            taken[a:b] = 1
    taken = np.concatenate([[0], np.cumsum(taken)])
    starts, ends, rows = spans(~NOT_WORD[data[: bounds[-1]]], bounds)
    free = taken[ends] == taken[starts]
    starts, ends, rows = starts[free], ends[free], rows[free]
    base = before[bounds[rows]]
    return texts, found, hash_spans(LOWER[data], starts, ends), rows, before[starts] - base, before[ends] - base


def _once(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word of each row once, by row."""
    order = np.lexsort((words, rows))
    words, rows = words[order], rows[order]
    new = np.concatenate([[True], (words[1:] != words[:-1]) | (rows[1:] != rows[:-1])])[: len(words)]
    return words[new], rows[new]


def _lists(values: np.ndarray, rows: np.ndarray, size: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(size + 1)), pa.int32()), pa.array(values.view(np.int64)))


def _find(batches):
    """row, doc_id, key, spans, entities, terms of each document: row is a number of its own, and terms are the words of documents that have entities."""
    task, number = TaskContext.get().partitionId() << 40, 0
    for piece in pieces(batches, READ):
        n = piece.num_rows
        texts, found, words, rows, _, _ = _read(piece)
        values = [(i, _value(kind, texts[i][a:b])) for i, f in enumerate(found) for kind, a, b in f]
        entity = _once(_hashes([v for _, v in values]), np.array([i for i, _ in values], np.int64))
        wanted = np.array([*map(bool, found)])[rows]
        term = _once(words[wanted], rows[wanted])
        places = pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found], pa.list_(_SPAN))
        arrays = [pa.array(task + number + np.arange(n)), piece.column("doc_id"), piece.column("key"), places, _lists(*entity, n), _lists(*term, n)]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "key", "spans", "entities", "terms"])
        number += n


def _term_counts(batches):
    """term, documents that have it outside of entities."""
    for piece in pieces(batches, READ):
        _, _, words, rows, _, _ = _read(piece)
        term, counts = np.unique(_once(words, rows)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(counts, pa.int64())], names=["term", "documents"])


def _places(table: np.ndarray, everywhere: bool):
    """doc_id, key, term, start, end of the words whose bit in the table is set, of documents with an entity or of all."""

    def run(batches):
        for piece in pieces(batches, READ):
            _, found, words, rows, starts, ends = _read(piece)
            if not everywhere:
                held = np.array([*map(bool, found)])[rows]
                words, rows, starts, ends = words[held], rows[held], starts[held], ends[held]
            place = words & np.uint64(8 * len(table) - 1)
            hit = (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            row = pa.array(rows[hit])
            arrays = [piece.column("doc_id").take(row), piece.column("key").take(row), pa.array(words[hit].view(np.int64)), pa.array(starts[hit], pa.int32()), pa.array(ends[hit], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "term", "start", "end"])

    return run


def _bits(terms: DataFrame) -> np.ndarray:
    """A table of bits, a power of two of them, with the bits of the terms set."""
    size = 1 << min(max(15, (32 * terms.count()).bit_length()), TABLE.bit_length() - 1)
    return bit_table(terms.select(F.col("term").bitwiseAND(size - 1).alias("place")), size)


def _known(rows: DataFrame, known: DataFrame, key: str, often: Column, wanted: Column) -> DataFrame:
    """Rows joined to the ``wanted`` of what is known by key. Keys that occur often are broadcast and never shuffled, so that no task gets all rows of one."""
    hot = F.broadcast(known.where(often))
    seldom = rows.join(F.broadcast(known.where(often).select(key)), key, "left_anti").join(known.where(~often & wanted), key)
    return rows.join(hot.where(wanted), key).unionByName(seldom)


def _join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by doc_id, which may be null, and key."""
    right = right.withColumnsRenamed({"doc_id": "other_id", "key": "other_key"})
    return left.join(right, (F.col("key") == F.col("other_key")) & F.col("doc_id").eqNullSafe(F.col("other_id")), "left").drop("other_id", "other_key")


def _disclosing(docs: DataFrame, found: DataFrame, disclosed: float) -> DataFrame:
    """term, with_term of the terms that disclose an entity.

    n_both is at most n_entity, so a term that discloses has n_term + SMOOTH <= n_entity ** disclosed * N ** (1 - disclosed); other pairs are not formed. Entities of exactly the same documents
    are one class, as they have the same counts with every term.
    """
    total = float(max(found.count(), 1))
    having = found.where(F.size("entities") > 0)
    held = having.select("row", F.explode("entities").alias("entity"))
    owners = stored(held.groupBy("entity").agg(F.count("*").alias("with_entity"), F.bit_xor(F.xxhash64("row")).alias("class")), "owners")
    counts = docs.where("text IS NOT NULL").mapInArrow(_term_counts, "term long, documents long")
    counts = stored(counts.groupBy("term").agg(F.sum("documents").alias("with_term")), "terms")
    bound = F.pow("with_entity", F.lit(disclosed)) * (total ** (1 - disclosed) * (1 + 1e-9))
    most = owners.agg(F.max(bound)).first()[0] or 0.0
    classes = stored(_known(held, owners, "entity", F.col("with_entity") > OFTEN * total, F.lit(True)).select("row", "class", "with_entity").distinct(), "classes")
    limits = classes.groupBy("row").agg(F.max(bound).alias("bound"))
    seen = having.select("row", "terms").join(limits, "row").select("row", "bound", F.explode("terms").alias("term"))
    seen = _known(seen, counts, "term", F.col("with_term") > OFTEN * total, F.col("with_term") + SMOOTH <= most).where(F.col("with_term") + SMOOTH <= F.col("bound")).drop("bound")
    pairs = seen.join(classes, "row").where(F.col("with_term") + SMOOTH <= bound)
    pairs = pairs.groupBy("class", "with_entity", "term", "with_term").agg(F.count("*").alias("both"))
    information = F.log(F.lit(total) / F.col("with_entity"))
    revealed = F.log(F.col("both") * F.lit(total) / (F.col("with_entity") * (F.col("with_term") + SMOOTH)))
    return pairs.where((information > 0) & (revealed >= disclosed * information)).select("term", "with_term").distinct()


def personal_data(documents: DataFrame, disclosed: float = DISCLOSED, everywhere: bool = False) -> DataFrame:
    """doc_id, key, spans, terms of each document: the patterns' spans (kind, start, end in code points) by kind and start, and the disclosing terms' by start.

    Terms are words outside of entities; each place of a disclosing term is listed in documents that hold an entity, with ``everywhere`` in all. Null and empty texts have no spans. Repeated rows get the same
    spans, and count as documents each; key is a hash of the text that tells rows of one doc_id apart. An entity or term is counted once a document. Other columns are ignored.
    """
    docs = columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    found = stored(docs.mapInArrow(_find, f"row long, doc_id long, key long, spans {_SPAN_SQL}, entities array<long>, terms array<long>"), "entities")
    risky = stored(_disclosing(docs, found, disclosed), "risky")
    table = _bits(risky)
    placed = docs.where("text IS NOT NULL").mapInArrow(_places(table, everywhere), "doc_id long, key long, term long, start int, end int")
    placed = stored(placed, "places")
    term = F.struct(F.lit("term").alias("kind"), F.col("start"), F.col("end"))
    terms = _known(placed, risky, "term", F.col("with_term") > OFTEN * found.count(), F.lit(True))
    terms = terms.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(term)).alias("terms"))
    joined = _join(found.select("doc_id", "key", "spans"), terms)
    return joined.select("doc_id", "key", "spans", F.coalesce("terms", F.expr("slice(spans, 1, 0)")).alias("terms"))


def _written(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data_summary(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms."""
    rows = personal_data(documents)
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = _written(F.col("spans"))
    every = _written(F.concat("spans", "terms"))
    return rows.select("doc_id", *map(count, KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def _replace(batches):
    for piece in pieces(batches):
        texts = []
        for text, found in zip(piece.column("text").to_pylist(), piece.column("all").to_pylist()):
            out, done = [], 0
            for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= done:
                    out += [text[done : s["start"]], GENERAL[s["kind"]]]
                done = max(done, s["end"])
            texts.append("".join([*out, text[done:]]) if out else text)
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("key"), pa.array(texts, pa.string())], names=["doc_id", "key", "clean_text"])


def sanitised_texts(documents: DataFrame, everywhere: bool = False) -> DataFrame:
    """doc_id, key, clean_text of the documents that have entities or disclosing terms, which are generalised; overlapping spans become one."""
    found = personal_data(documents, everywhere=everywhere).select("doc_id", "key", F.concat("spans", "terms").alias("all")).where(F.size("all") > 0).dropDuplicates(["doc_id", "key"])
    docs = columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    joined = _join(docs, found).where("`all` IS NOT NULL").select("doc_id", "key", "text", "all")
    return joined.mapInArrow(_replace, "doc_id long, key long, clean_text string").dropDuplicates(["doc_id", "key"])
