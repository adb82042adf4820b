"""Pages from the network as a table: addresses in, bodies out, spread over the partitions of the addresses."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls

SCHEMA = "url string, final_url string, status int, body string, error string"


def fetch_pages(addresses: DataFrame, url: str, blocked: tuple[str, ...] = (), login_parts: tuple[str, ...] = urls.LOGIN_PARTS, timeout: float = 10.0, delay: float = 0.05, agent: str = "vacantis", most_bytes: int = 20_000_000) -> DataFrame:
    """(url, final_url, status, body, error) of every address of HTTP. Blocked hosts and logins are not asked, and a page that redirects to one has no body.

    A page that cannot be read has its error instead of stopping the task; each address is asked once a run of its task.
    """
    asked = addresses.select(F.col(url).alias("url")).where(F.col("url").rlike(r"(?i)^https?://")).distinct()
    refused = lambda c: F.when(urls.login_gated(F.col(c), login_parts), "login page").otherwise(urls.blocked_reason(F.col(c), blocked))
    asked = asked.where(refused("url") == "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u in b["url"]:
                try:
                    with urllib.request.urlopen(urllib.request.Request(u, headers={"User-Agent": agent}), timeout=timeout) as r:  # noqa: S310 - only http addresses come here
                        raw = r.read(most_bytes + 1)
                        if len(raw) > most_bytes:  # a page is taken whole or not at all
                            rows.append((u, r.geturl(), r.status, None, f"more than {most_bytes} bytes"))
                            continue
                        rows.append((u, r.geturl(), r.status, raw.decode(r.headers.get_content_charset() or "utf-8", "replace"), None))
                except urllib.error.HTTPError as e:
                    rows.append((u, e.geturl(), e.code, None, f"status {e.code}"))
                except (OSError, ValueError, LookupError) as e:
                    rows.append((u, None, None, None, type(e).__name__))
                time.sleep(delay)
            yield pd.DataFrame(rows, columns=["url", "final_url", "status", "body", "error"]).astype({"status": "Int32"})

    got = asked.mapInPandas(run, SCHEMA)
    reason = F.coalesce(refused("final_url"), F.lit(""))
    return got.select("url", "final_url", "status", F.when(reason == "", F.col("body")).alias("body"), F.coalesce("error", F.nullif(reason, F.lit(""))).alias("error"))
