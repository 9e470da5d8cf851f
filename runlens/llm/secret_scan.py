"""Secret scans: known shapes, and strings that a tokenizer can't shorten.

Four kinds of spans, in code points, the end exclusive:

- `assign`: a key word, `:` or `=`, and a value of 6 characters or more;
- `access`: access key ids;
- `hex`: 24 or more lower-case hex digits;
- `random`: the method's own.  A vocabulary learnt from text cuts ordinary
  words and names in a few long tokens, but random letters and digits in
  many short ones; a run of 20 or more key characters with both letters and
  digits is taken for a secret if it has few characters a token.  Runs that
  are known not to be secrets are left out: plain hex of a digest's length,
  UUIDs, and identifiers in words (`snake_case_2`, dotted or slashed paths).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from runlens.llm import arrays as A
from runlens.llm.tables import id_and_text, map_batches

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# A text without one of these has no `assign`; looked up in lower case.
ASSIGN_PARTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Maximal runs of 24 or more: the same as all runs, short ones dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20}

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
PART = re.compile(r"[+/_=-]+")
WORD = re.compile(r"[A-Za-z]*[0-9]{0,4}|[0-9]+")
# Characters a token: English runs above 4, base64 and random ids about 1.5.
LEAST_CHARS_A_TOKEN = 2.2
TOKENIZER = "byte_bpe_50k.tiktoken"

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
MASK = "[secret]"


@lru_cache(maxsize=2)
def encoding(name: str) -> tiktoken.Encoding:
    import public_tokenizers

    with open(public_tokenizers.path(name)) as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(str.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three fixed shapes, by start and kind."""
    found = []
    small = text.lower()
    if any(x in small for x in ASSIGN_PARTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _identifier(run: str) -> bool:
    """Digests, UUIDs and names made of words and short numbers."""
    if len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run) or UUID.fullmatch(run):
        return True
    return all(WORD.fullmatch(x) for x in PART.split(run))


def random_spans(text: str, name: str = TOKENIZER, least: float = LEAST_CHARS_A_TOKEN) -> list[tuple[int, int, str]]:
    found = []
    for m in RUN.finditer(text):
        run = m[0].rstrip("=-_/+")
        if re.search("[0-9]", run) and re.search("[A-Za-z]", run) and not _identifier(run) and len(run) < least * len(encoding(name).encode_ordinary(run)):
            found.append((m.start(), m.end(), "random"))
    return found


def secret_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans, by start, then in the order of KINDS."""
    return sorted([*base_spans(text), *random_spans(text)], key=lambda x: (x[0], KINDS.index(x[2])))


def masked(text: str, mask: str = MASK) -> str:
    """The text with each stretch of (overlapping) spans replaced."""
    out, at = [], 0
    for start, end, _ in secret_spans(text):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def _told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: counts, digest of base spans, all spans.

    A null or empty text has none: counts 0, the digest of no bytes, spans "".
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                out: list[tuple] = []
                for text in part.column(1).to_pylist():
                    spans = secret_spans(text)
                    kinds = [x[2] for x in spans]
                    told = _told([x for x in spans if x[2] != "random"])
                    out.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(told.encode()).hexdigest(), _told(spans), kinds.count("random")))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True))], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return map_batches(id_and_text(docs, id_col, text_col), rows, SCHEMA.replace("doc_id long", f"doc_id {docs.schema[id_col].dataType.simpleString()}"))


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with secrets replaced in the text, and its length set anew where
    the table has such a column; a null text stays null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch, text_col):
                at = part.schema.get_field_index(text_col)
                before = part.column(at).to_pylist()
                after = [x if x is None else masked(x) for x in before]
                part = part.set_column(at, part.schema.field(at), pa.array(after, part.column(at).type))
                if length_col in part.schema.names:
                    n = part.schema.get_field_index(length_col)
                    lengths = [old if x is y or y is None else len(y) for x, y, old in zip(before, after, part.column(n).to_pylist(), strict=True)]
                    part = part.set_column(n, part.schema.field(n), pa.array(lengths, part.column(n).type))
                yield part

    return map_batches(docs, rows, docs.schema)
