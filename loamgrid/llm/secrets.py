"""Secret scans with character Markov models.

Fixed patterns give the base spans. Two first-order character models, one of random strings and one of ordinary identifiers and words, are trained from labelled samples
and compared by the mean log-likelihood ratio of a token's transitions. The samples are of two sources, half of each model's weight each: the corpus (values of base spans with letters and digits are random;
numbers and everything else but the undecided tokens are ordinary) and a seeded, bounded set that does not depend on it (strings drawn from the usual alphabets; names of Python's standard library, in snake and camel case, with and
without numbers). Transition counts are added up per task, so a model's size does not depend on the input.

The models decide twice. A token outside the base spans (letters and digits, 12 characters or more; 8 or more behind a word for credentials or as the password of a URL) is a
further secret if its ratio is high enough. And every span gets its ratio: a base span that looks like a number or a word stays, but does not count as ``likely``.

Null text is empty; repeated rows give repeated results; an empty table gives an empty result; a text of any length is scanned whole, in time linear in its length and spans;
other columns, whatever their names, are ignored. Positions are code points.
"""

from __future__ import annotations

import argparse
import base64
import calendar
import collections
import concurrent.futures
import csv
import datetime
import email.message
import functools
import hashlib
import http
import inspect
import json
import logging
import os
import pathlib
import random
import re
import shutil
import socket
import ssl
import statistics
import string
import subprocess
import tarfile
import textwrap
import threading
import unittest
import urllib.parse
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import map_texts, read_documents

KINDS = ("assign", "access", "hex")
MODEL_KIND = "model"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = re.compile(rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 16 or more are the runs that do not fail the length rule.
HEX = re.compile(r"[0-9a-f]{16,}")
#: Tokens of 8 or more; those of fewer than PLAIN_LENGTH characters count in a context of credentials only.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
PLAIN_LENGTH = 12
LOCK = re.compile(r"""(?:(?<![A-Za-z])(?:pwd|pass(?:phrase|code)?|auth(?:orization)?|bearer|basic|credentials?|private|client|access|signing|encryption|session|key|sig(?:nature)?|pin)["']?\s*(?:[:=]|\bis\b)?\s*["'(]?|://[^\s:/@]{1,64}:)$""", re.I)
#: Characters before a token in which such a word may stand.
LOCK_CHARS = 80
MIXED = re.compile(r"(?=[^A-Za-z]*[A-Za-z])(?=[^0-9]*[0-9])")
#: Characters 127 and up share a symbol.
SYMBOLS = 128
#: Least mean log-likelihood ratio per transition of a secret, of a secret in a context of credentials, and of a likely one among the base spans.
THRESHOLD, LOCK_THRESHOLD, LIKELY = 0.5, 0.2, 0.5
#: Pseudo-counts of a transition; for random strings between the characters of CANDIDATE only.
PRIOR = 0.5
#: Alphabets of the random samples, and how many strings are drawn from each.
ALPHABETS = ("0123456789abcdef", string.digits + string.ascii_lowercase, string.digits + string.ascii_letters, string.digits + string.ascii_letters + "-_", string.digits + string.ascii_letters + "+/")
DRAWN = 400


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` by start, then kind as listed."""
    out = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def transitions(text: str) -> np.ndarray:
    """Counts of symbol pairs; the text is seen between spaces."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = np.minimum(points, SYMBOLS - 1).astype(np.int64)
    return np.bincount(symbols[:-1] * SYMBOLS + symbols[1:], minlength=SYMBOLS * SYMBOLS)


def random_samples(seed: int) -> list[str]:
    """Strings of 12 to 64 characters drawn from each alphabet."""
    rng = random.Random(seed)
    return ["".join(rng.choices(a, k=rng.randint(12, 64))) for a in ALPHABETS for _ in range(DRAWN)]


def ordinary_samples() -> list[str]:
    """Public names of modules of the standard library, as they are, in the other case, with a number, and joined in pairs."""
    names = sorted({n for m in (argparse, base64, calendar, collections, concurrent.futures, csv, datetime, email.message, functools, http, inspect, json, logging, os, pathlib, shutil, socket, ssl, statistics, string, subprocess, tarfile, textwrap, threading, unittest, urllib.parse, zipfile) for n in dir(m) if not n.startswith("_") and len(n) > 3})
    out = []
    for i, n in enumerate(names):
        camel = "".join(p.capitalize() for p in n.lower().split("_"))
        other = names[(i * 7 + 3) % len(names)]
        out += [n, camel, f"{n.lower()}{i % 100}", f"{n.lower()}_{other.lower()}", f"{camel[:1].lower()}{camel[1:]}{other.capitalize()}{i % 10}", f"{n.lower()}-{i % 32}-{other.lower()}", f"{n.lower()}/{other.lower()}/{i * 37 % 2000}"]
    return out


def transition_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``secret, pair, n`` over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                if not text:
                    continue
                at, rest = 0, []
                for _, start, end, value in base_spans(text):
                    counts[1 if MIXED.match(value) else 0] += transitions(value)
                    if start >= at:
                        rest.append(text[at:start])
                    at = max(at, end)
                rest.append(text[at:])
                counts[0] += transitions(CANDIDATE.sub(lambda m: " " if MIXED.match(m[0]) else m[0], " ".join(rest)))  # undecided tokens train neither
        for secret in (0, 1):
            pairs = np.flatnonzero(counts[secret])
            yield pd.DataFrame({"secret": secret, "pair": pairs, "n": counts[secret][pairs]})

    parts = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "secret int, pair int, n long")
    return parts.groupBy("secret", "pair").agg(F.sum("n").alias("n"))


def sample_counts(seed: int = 1) -> np.ndarray:
    """Transitions of the ordinary and the random samples that do not depend on the corpus."""
    return np.stack([sum(map(transitions, x)) for x in (ordinary_samples(), random_samples(seed))])


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log P(next | random) - log P(next | ordinary) for each pair; the table has a fixed number of rows."""
    corpus = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in counts.collect():  # at most 2 * SYMBOLS**2 rows
        corpus[r["secret"], r["pair"]] += r["n"]
    allowed = np.array([chr(i) == " " or bool(re.fullmatch(r"[A-Za-z0-9+/_=.-]", chr(i))) for i in range(SYMBOLS)])
    models = 0.0
    for table in (corpus, sample_counts()):
        table = table.reshape(2, SYMBOLS, SYMBOLS) + PRIOR
        table[1][:, ~allowed] -= PRIOR - 1e-3
        models = models + table / table.sum(axis=2, keepdims=True) / 2
    logs = np.log(models)
    return (logs[1] - logs[0]).ravel()


def score(token: str, ratios: np.ndarray) -> float:
    """Mean log-likelihood ratio of the token's inner transitions."""
    symbols = np.frombuffer(token.encode("ascii"), np.uint8).astype(np.int64)
    return float(ratios[symbols[:-1] * SYMBOLS + symbols[1:]].mean())


def model_spans(text: str, base: list, ratios: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[str, int, int, str, float]]:
    """Candidates that overlap no base span (``base`` comes by start) and score enough, with their score."""
    out = []
    i = reached = 0  # base spans that start before the candidate's end, and the largest end among them
    for m in CANDIDATE.finditer(text):
        if not MIXED.match(m[0]):
            continue
        while i < len(base) and base[i][1] < m.end():
            reached = max(reached, base[i][2])
            i += 1
        if reached > m.start():
            continue
        own = score(m[0], ratios)
        if own >= threshold and len(m[0]) >= PLAIN_LENGTH or own >= LOCK_THRESHOLD and LOCK.search(text[max(0, m.start() - LOCK_CHARS) : m.start()]):
            out.append((MODEL_KIND, m.start(), m.end(), m[0], own))
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id and ``found``, an array of spans ``kind, start, end, value, ratio`` (base spans first). ``ratio`` is the models' mean log-likelihood ratio of the value."""
    ratios = log_ratios(transition_counts(docs, text_col))

    def run(texts: list[str | None]):
        found = []
        for text in texts:
            base = base_spans(text or "")
            spans = [(*s, score(s[3], ratios)) for s in base] + model_spans(text or "", base, ratios, threshold)
            found.append([{"kind": k, "start": s, "end": e, "value": v, "ratio": r} for k, s, e, v, r in spans])
        return None, [found]

    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("ratio", pa.float64())])
    columns = [("found", "array<struct<kind:string,start:int,end:int,value:string,ratio:double>>", pa.list_(span))]
    return map_texts(docs, id_col, text_col, columns, run, id_col)


def digest(spans: list[tuple]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans).encode()).hexdigest()


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_documents(spark, sf_dir))
    show = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    order = F.create_map(*[F.lit(x) for kv in ((k, i) for i, k in enumerate((*KINDS, MODEL_KIND))) for x in kv])
    by_place = F.transform(F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(show(F.filter("found", lambda s: s["kind"] != MODEL_KIND)), 256).alias("base_sha256"),
        show(by_place).alias("spans"),
        F.size(F.filter("found", lambda s: s["ratio"] >= LIKELY)).cast("long").alias("n_likely"),
        F.round(F.array_max(F.transform("found", lambda s: s["ratio"])), 6).alias("top_ratio"),
    )
