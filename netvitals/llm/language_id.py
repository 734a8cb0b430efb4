"""Language identification by Bayesian fusion of evidence.

log P(lang | evidence) = text + declared + address + prior, up to a constant:

* text: byte trigrams under one smoothed model per language, counted over every labelled text;
  the sum is tempered to ``text_weight`` trigrams, as those of a long text are not independent.
  A labelled text's own trigrams are left out of its language's counts when it is told itself;
* declared: the language a page's markup declares, right with probability ``declared_right``;
* address: a language code as the first part of the path, right with ``address_right``;
* prior: how often the host's rows read as each language. Rows are counted by their likeliest
  language under the text alone, and counts of a host are smoothed by its registered domain,
  the domain's by the address suffix, the suffix's by the whole table. A row's own count is
  taken out of each, so that its text is not used twice.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.llm.words import pieces
from netvitals.plans.shared import settle

SLOTS = 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_CLOSER = re.compile(rb"</(script|style)\s*>", re.I)
_OPENER = re.compile(rb"<(script|style)\b", re.I)
_REFERENCE = re.compile(rb"&[#\w]{1,10};")
_DECLARED = re.compile(rb"<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b", re.I)
LEVELS = ("host", "domain", "suffix")


def _trigrams(data: np.ndarray) -> np.ndarray:
    """The slot of the trigram that begins at each byte: letters in lower case, anything else
    a boundary."""
    low = _LOWER[data]
    low = np.where(_LETTER[low], low, 32).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.uint32)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def _counter(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for lo, hi, data, offsets in pieces(batch.column("text")):
            slot = _trigrams(data)
            own = np.array(names[lo:hi])
            of = np.repeat(np.arange(hi - lo), np.diff(offsets))[: len(slot)]
            # Trigrams over the end of a text belong to none.
            whole = np.arange(len(slot)) + 3 <= offsets[1:][of]
            for lang in np.unique(own):
                mine = slot[whole & (own == lang)[of]]
                if lang not in total:
                    total[lang] = np.zeros(SLOTS, np.int64)
                total[lang] += np.bincount(mine, minlength=SLOTS)
    rows = [(lang, np.flatnonzero(n)) for lang, n in total.items()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([lang for lang, s in rows for _ in range(len(s))], pa.string()),
            pa.array(np.concatenate([s for _, s in rows] or [np.zeros(0, np.int64)])),
            pa.array(np.concatenate([total[lang][s] for lang, s in rows] or [np.zeros(0, np.int64)])),
        ],
        names=["lang", "slot", "n"],
    )


class LanguageModel:
    """Log probabilities of trigram slots by language: languages x 65,536 numbers."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.counts = languages, counts
        smooth = counts + 0.5
        self.table = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)

    def likelihoods(
        self, data: np.ndarray, offsets: np.ndarray, weight: float, labels: list[str | None] | None = None
    ) -> np.ndarray:
        """log P(text | lang) for each text, tempered to ``weight`` trigrams; 0 without letters.
        A text with a label is judged by counts of that language that leave it out."""
        slot = _trigrams(data)
        blank = _trigrams(np.full(3, 32, np.uint8))[0]
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(slot):
            return out
        last = np.maximum(offsets[1:] - 2, offsets[:-1])
        real = np.concatenate([[0], np.cumsum(slot != blank)])
        last, start = np.minimum(last, len(slot)), np.minimum(offsets[:-1], len(slot))
        n = real[last] - real[start]
        share = np.where(n > 0, np.minimum(n, weight) / np.maximum(n, 1), 0.0)
        for k in range(len(self.languages)):
            worth = np.where(slot == blank, 0.0, self.table[k][slot])
            total = np.concatenate([[0.0], np.cumsum(worth, dtype=np.float64)])
            out[:, k] = (total[last] - total[start]) * share
        number = {x: i for i, x in enumerate(self.languages)}
        all_counts = self.counts.sum(1)
        for i, label in enumerate(labels or ()):
            k = number.get(label)
            if k is not None and n[i]:
                own, times = np.unique(slot[start[i] : last[i]], return_counts=True)
                rest = np.maximum(self.counts[k][own] - times, 0) + 0.5
                whole = max(all_counts[k] - times.sum(), 0) + 0.5 * SLOTS
                worth = times * np.log(rest / whole)
                out[i, k] = worth[own != blank].sum() * share[i]
        return out


def train_languages(labelled: DataFrame) -> LanguageModel:
    """A model of (text, lang): every row with a language counts, its text whole. Without
    labelled rows it knows no language."""
    rows = labelled.filter("lang IS NOT NULL").select("lang", "text")
    counts = rows.mapInArrow(_counter, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    seen = counts.toArrow()  # languages x slots at most
    names = seen["lang"].to_pylist()
    languages = sorted(set(names))
    table = np.zeros((len(languages), SLOTS))
    number = {x: i for i, x in enumerate(languages)}
    table[[number[x] for x in names], seen["slot"].to_numpy()] = seen["n"].to_numpy()
    return LanguageModel(languages, table)


def visible(html: bytes) -> bytes:
    """A page's text: no scripts, styles, comments, tags or character references. One pass: a
    script, style or comment that is never closed is an ordinary tag, a tag that is never closed
    is text."""
    ends: dict[bytes, list[tuple[int, int]]] = {b"script": [], b"style": []}
    for m in _CLOSER.finditer(html):
        ends[m[1].lower()].append(m.span())
    out, at, comments = [], 0, True
    while (i := html.find(b"<", at)) >= 0:
        stop = -1
        if html.startswith(b"<!--", i) and comments:
            stop = html.find(b"-->", i + 4) + 3
            comments = stop > 2
            stop = stop if comments else -1
        elif opener := _OPENER.match(html, i):
            closers = ends[opener[1].lower()]
            k = bisect_left(closers, (i,))
            stop = closers[k][1] if k < len(closers) else -1
        if stop < 0:
            stop = html.find(b">", i) + 1
            if not stop:
                break
        out.append(html[at:i])
        at = stop
    out.append(html[at:])
    return _REFERENCE.sub(b" ", b" ".join(out))


def text_evidence(
    rows: DataFrame, model: LanguageModel, weight: float, markup: bool, label: str | None = None
) -> DataFrame:
    """``rows`` with ``text_ll array<double>`` and ``declared`` in the place of ``text``; of
    pages (``markup``), the declared language is read from the markup. ``label`` is a column with
    the language under which the model has counted a row's text; it is dropped."""
    names = [c for c in rows.columns if c not in ("text", "declared", "text_ll", label)]
    shape = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema])
    shape += ", text_ll array<double>, declared string"
    width = len(model.languages)

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(len(names))):
                said = [None] * (hi - lo)
                if markup:
                    raw = data.tobytes()
                    pages = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
                    tags = [_DECLARED.search(p) for p in pages]
                    said = [t[1].decode().lower() if t else None for t in tags]
                    shown = [visible(p) for p in pages]
                    data = np.frombuffer(b"".join(shown), np.uint8)
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p in shown])])
                labels = batch.column(len(names) + 1).slice(lo, hi - lo).to_pylist() if label else None
                ll = model.likelihoods(data, offsets, weight, labels)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(hi - lo + 1, dtype=np.int32) * width), pa.array(ll.ravel())
                )
                own = [batch.column(i).slice(lo, hi - lo) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*own, lists, pa.array(said, pa.string())], names=[*names, "text_ll", "declared"]
                )

    return rows.select(*names, "text", *([label] if label else [])).mapInArrow(run, shape)


def with_address(rows: DataFrame, url: Column) -> DataFrame:
    """Adds ``host``, ``domain`` (its last two labels), ``suffix`` (the last) and
    ``path_code`` (a first path part of two letters) of an address, each null where absent."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    code = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return rows.select(
        "*",
        host.alias("host"),
        F.when(domain != "", domain).otherwise(host).alias("domain"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.when(code != "", code).alias("path_code"),
    )


def _best(scores: Column, languages: list[str]) -> Column:
    """The language of the greatest score, the first of equals; null if all are equal."""
    top = F.array_max(scores)
    at = F.array_position(scores, top).cast("int")
    return F.when(top > F.array_min(scores), F.element_at(F.array(*[F.lit(x) for x in languages]), at))


def identify(
    evidence: DataFrame,
    languages: list[str],
    declared_right: float = 0.9,
    address_right: float = 0.9,
    strength: float = 10.0,
) -> DataFrame:
    """``evidence`` (text_ll, declared, path_code, host, domain, suffix and any others) with
    ``text_lang, lang, probability``.

    Counts are taken by grouped aggregation over all rows and met again by their keys, large
    hosts split by AQE. Defined cases: a row without letters has no text_lang and is told by
    the rest; codes of unknown languages count as absent; rows without an address share the
    null host, with all its counts; repeated rows count each; ties go to the first language.
    """
    k = len(languages)
    rows = evidence.withColumn("text_lang", _best(F.col("text_ll"), languages))
    rows = settle(rows, "lang_evidence")
    tally = [F.count_if(F.col("text_lang") == x).cast("double") for x in languages]

    def counted(keys: list[str], name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.array(*tally).alias(name))

    keys = list(LEVELS)
    hosts = settle(counted(keys, "n_host"), "lang_hosts")

    def rolled(level: list[str], frame: DataFrame, name: str, new: str) -> DataFrame:
        parts = [F.sum(F.col(name)[i]) for i in range(k)]
        return frame.groupBy(*level).agg(F.array(*parts).alias(new))

    domains = rolled(keys[1:], hosts, "n_host", "n_domain")
    suffixes = rolled(keys[2:], hosts, "n_host", "n_suffix")
    # a number for each language
    whole = rolled([], hosts, "n_host", "n_all").first()[0]
    everything = F.array(*[F.lit(float(n or 0.0)) for n in whole])

    def meet(left: DataFrame, right: DataFrame, level: list[str]) -> DataFrame:
        named = right.select(*[F.col(c).alias(f"_{c}") for c in level], *[c for c in right.columns if c not in level])
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in level]
        return left.join(named, on).drop(*[f"_{c}" for c in level])

    priors = meet(meet(hosts, domains, keys[1:]), suffixes, keys[2:]).withColumn("n_all", everything)
    priors = settle(priors, "lang_priors")
    rows = meet(rows, priors, keys)

    def own(i: int) -> Column:
        return F.when(F.col("text_lang") == languages[i], 1.0).otherwise(0.0)

    def prior(i: int) -> Column:
        p = F.lit(1.0 / k)
        for name in ("n_all", "n_suffix", "n_domain", "n_host"):
            total = sum((F.col(name)[j] - own(j) for j in range(k)), F.lit(0.0))
            p = (F.col(name)[i] - own(i) + strength * p) / (total + strength)
        return p

    def said(name: str, i: int, right: float) -> Column:
        wrong = (1 - right) / max(k - 1, 1)
        known = F.col(name).isin(*languages)
        return F.when(known, F.when(F.col(name) == languages[i], right).otherwise(wrong)).otherwise(1.0)

    scores = [
        F.col("text_ll")[i]
        + F.log(said("declared", i, declared_right))
        + F.log(said("path_code", i, address_right))
        + F.log(prior(i))
        for i in range(k)
    ]
    rows = rows.withColumn("_score", F.array(*scores))
    top = F.array_max("_score")
    mass = F.aggregate("_score", F.lit(0.0), lambda a, s: a + F.exp(s - top))
    names = F.array(*[F.lit(x) for x in languages])
    lang = F.element_at(names, F.array_position("_score", top).cast("int"))
    kept = [c for c in evidence.columns if c not in ("text_lang", "lang", "probability")]
    return rows.select(*kept, "text_lang", lang.alias("lang"), (1 / mass).alias("probability"))


def identify_corpus(
    pages: DataFrame, documents: DataFrame, text_weight: float = 50.0, **options
) -> DataFrame:
    """``page_id, doc_id, lang, probability, text_lang`` for every page and every document.

    Pages give all kinds of evidence; documents have no markup or address, and their source
    stands for the host. Models are trained on the languages of ``documents``, so for
    documents only text and source speak, and each is judged by counts without itself. Null texts
    and addresses are absent evidence; null ids are carried along; without any labelled document
    languages and probabilities are null; no rows give no rows; other columns are not read.
    """
    model = train_languages(documents)
    if not model.languages:
        ids = pages.select("page_id", F.lit(None).cast("long").alias("doc_id")).unionByName(
            documents.select(F.lit(None).cast("long").alias("page_id"), "doc_id")
        )
        nothing = F.lit(None)
        return ids.select(
            "*",
            nothing.cast("string").alias("lang"),
            nothing.cast("double").alias("probability"),
            nothing.cast("string").alias("text_lang"),
        )
    named = pages.select("page_id", F.lit(None).cast("long").alias("doc_id"), "url", F.col("html").alias("text"))
    read = with_address(text_evidence(named, model, text_weight, True), F.col("url")).drop("url")
    plain = documents.select(F.lit(None).cast("long").alias("page_id"), "doc_id", "source", "text", "lang")
    other = text_evidence(plain, model, text_weight, False, "lang").select(
        "page_id",
        "doc_id",
        "text_ll",
        "declared",
        F.concat(F.lit("source:"), "source").alias("host"),
        F.concat(F.lit("source:"), "source").alias("domain"),
        F.lit("source:").alias("suffix"),
        F.lit(None).cast("string").alias("path_code"),
    )
    found = identify(read.unionByName(other), model.languages, **options)
    return found.select("page_id", "doc_id", "lang", "probability", "text_lang")
