"""The corpus pipeline: documents through five operators, each stage written and read again.

Columns of ``documents`` (doc_id, text, lang, source, n_chars, and any others) go through
unchanged up to the last stage, which gives the token ids of each row of the mixture. A
table without rows passes every stage; the operators' docstrings define the other cases.
"""

from __future__ import annotations

from arealis.llm import bpe, exact_dedup, jaccard_join, language_id, mixing
from arealis.llm.common import documents, stored

# a text none of whose languages is this likely is rejected; short and mixed texts of
# known languages come out above it
SURE = 0.4


def known_language(spark, docs, sf_dir):
    """Stage 1: rows whose text has no letter or no likely language go."""
    found = language_id.identify(docs, language_id.fit(docs))
    return found.where((found.lang_pred != language_id.UNKNOWN) & (found.score >= SURE)).select(*[f"`{c}`" for c in docs.columns])


def drop_copies(spark, docs, sf_dir):
    """Stage 2: of texts equal up to white space, one stays."""
    return exact_dedup.unique(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Stage 3: of documents linked by similar shingles, one stays."""
    return jaccard_join.thinned(docs)


def mix_sources(spark, docs, sf_dir):
    """Stage 4: documents are repeated or left out to meet the sources' weights."""
    return mixing.mix(docs, mixing.TARGET, seed=6).select(*[f"`{c}`" for c in docs.columns])


def encode(spark, docs, sf_dir):
    """Stage 5: token ids, with the digests of the ids and of the decoded text."""
    return bpe.round_trip(docs, texts=True).drop("decoded")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark, sf_dir):
    """The last stage's rows for ``documents``."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)


# the language model of the first stage has no form in SQL
ORACLE_SQL = None
