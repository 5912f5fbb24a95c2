"""Embedded images of documents as rows, and whether documents can be published with them.

Defined cases: a null document has no images; bytes that don't decode make a
broken image and no error.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from pagewright.functions import images

STATES = ("missing", "unsupported", "broken", "remote", "embedded")


@udtf(returnType="n: int, state: string, skipped: boolean, mime: string, bytes: long, width: int, height: int, strip: boolean")
class InlineImages:
    """Images of a document: whether each can be shown, and what its header says."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, (src, skipped) in enumerate(images.sources(html or "")):
            found = images.payload(src)
            size = images.pixel_size(found.data) if found else None
            yield n, images.state(src), skipped, found and found.mime, len(found.data) if found and found.data else None, *(size or (None, None)), bool(size and images.is_page_strip(*size))


def inline_images(df: DataFrame, html: str) -> DataFrame:
    return df.lateralJoin(InlineImages(F.col(html).outer()))


def integrity(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Counts for each document: image_count, one for each kind of fault, and the skipped ones among the faulty. Documents without images have zeros."""
    found = inline_images(df.select(*keys, html), html)
    fault = F.col("state").isin("missing", "unsupported", "broken")
    counts = found.groupBy(*keys).agg(F.count("*").alias("image_count"), *[F.count(F.when(F.col("state") == s, 1)).alias(f"{s}_count") for s in STATES[:3]], F.count(F.when(fault & F.col("skipped"), 1)).alias("skipped_count"))
    columns = counts.columns[len(keys) :]
    return df.select(*keys).join(counts, keys, "left").select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
