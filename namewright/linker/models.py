"""Optional connectors to models: a chat model that classifies rows, a reranker that chooses among products.

Off by default.  A connector is given the function that posts a request, so that nothing here knows an address or a key
and tests need no network; keys come from the environment of whoever makes that function.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from ..shipping import ship
from .classify import answers, brand_candidates, prompt_line

MODES = ("local", "llm", "both")
TRIES, WAIT_SECONDS, BATCH = 5, 10, 2
PROMPT = "For each row say whether it is a product of one of the candidate brands (1 is garbage, 0 a product). Answer a line n=0 or n=1 for each of the {n} rows and nothing else.\n{rows}"


@dataclass(frozen=True)
class Reply:
    """What a post gives: status of the answer, its body, and its headers."""

    status: int
    body: dict
    headers: dict = field(default_factory=dict)


Post = Callable[[dict], Reply]


def enabled(mode: str) -> bool:
    """Whether a mode asks models."""
    if mode not in MODES:
        raise ValueError(f"mode {mode} is none of {', '.join(MODES)}")
    return mode != "local"


def asked(post: Post, payload: dict, tries: int = TRIES, wait: float = WAIT_SECONDS, sleep: Callable[[float], None] = time.sleep) -> dict | None:
    """The body of an answer.  Too many requests wait as long as the answer says, other failures twice as long each time; nothing after the last try."""
    for k in range(tries):
        try:
            reply = post(payload)
            if reply.status == 429:
                said = str(reply.headers.get("Retry-After", ""))
                sleep(int(said) if said.isdigit() else wait)
                wait *= 2
                continue
            if reply.status < 400:
                return reply.body
        except Exception:  # noqa: BLE001  any failure is tried again
            pass
        if k < tries - 1:
            sleep(wait)
            wait *= 2
    return None


def classify_batch(names: list[str], brands: list[str], post: Post, model: str, **how) -> tuple[list[str], int, int]:
    """Answers for some rows (0, 1, BAD_OUTPUT or ERROR), and the tokens that were read and written."""
    rows = "\n".join(prompt_line(k, n, brand_candidates(n, brands)) for k, n in enumerate(names, 1))
    payload = {"model": model, "messages": [{"role": "user", "content": PROMPT.format(n=len(names), rows=rows)}], "temperature": 0, "max_tokens": 60 * len(names) + 100}
    body = asked(post, payload, **how)
    usage = (body or {}).get("usage", {})
    text = body["choices"][0]["message"]["content"] if body else None
    return answers(text, len(names)), int(usage.get("prompt_tokens", 0)), int(usage.get("completion_tokens", 0))


def classify_by_model(names: DataFrame, brands: list[str], post: Post, model: str, batch: int = BATCH, pause: float = 0.0) -> DataFrame:
    """names (name) -> (name, answer, input_tokens, output_tokens); a batch's tokens stand with its first row.  Tasks pause between calls."""
    ship(names.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for a in range(0, len(frame), batch):
                own = frame["name"].iloc[a : a + batch].tolist()
                said, read, written = classify_batch(own, brands, post, model)
                out += [(n, x, read if k == 0 else 0, written if k == 0 else 0) for k, (n, x) in enumerate(zip(own, said, strict=True))]
                time.sleep(pause)
            yield pd.DataFrame(out, columns=["name", "answer", "input_tokens", "output_tokens"])

    return names.select("name").mapInPandas(run, "name string, answer string, input_tokens int, output_tokens int")


def reranker(post: Post, model: str, **how) -> Callable[[str, list[str]], tuple[int, float]]:
    """A reranker for `link`: the place and score of the document of highest relevance; an error where there is no answer."""

    def rerank(query: str, documents: list[str]) -> tuple[int, float]:
        body = asked(post, {"model": model, "query": query, "documents": documents, "top_n": len(documents)}, **how) or {}
        found = body.get("results") or body.get("data") or []
        if not found:
            raise RuntimeError("the reranker gave no results")
        top = max(found, key=lambda r: r.get("relevance_score", 0))
        return int(top.get("index", 0)), float(top.get("relevance_score", 0))

    return rerank
