"""Label boxes to a filled table: rows, columns, cells, texts in cells."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.operators import structure
from docsynth.operators.spatial import buckets_of, page_join, split_pages
from docsynth.session import materialise, materialise_by

def over_pages(boxes: DataFrame, step: Callable[[Recovery], DataFrame]) -> DataFrame:
    """``step`` on the small pages, dealt out once by page, and on the large ones, dealt out by bands and tiles."""
    small, large = split_pages(boxes)
    parts = [Recovery(small, True)] + ([] if large is None else [Recovery(large)])
    return reduce(DataFrame.unionByName, [step(part) for part in parts])


class Recovery:
    """The stages of one recovery. Stages that several later ones read are written once to the shared folder.

    With ``whole`` the pages are small: their texts are dealt out by page once, and the stages are written in buckets of
    pages, so that no later stage deals them out again.
    """

    def __init__(self, boxes: DataFrame, whole: bool = False):
        self.source, self.whole = boxes, whole

    @cached_property
    def buckets(self) -> int:
        return buckets_of(self.source)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        return materialise_by(df, name, "image_id", self.buckets) if self.whole else materialise(df, name)

    @cached_property
    def boxes(self) -> DataFrame:
        return self.rows.drop("row_no") if self.whole else self.source

    @cached_property
    def rows(self) -> DataFrame:
        dealt = self.source.repartition(self.buckets, "image_id") if self.whole else self.source
        return self.kept(structure.row_clusters(dealt, self.whole), "recovery-rows")

    @cached_property
    def sizes(self) -> DataFrame:
        return structure.line_sizes(self.rows)

    @cached_property
    def full_rows(self) -> DataFrame:
        full = structure.full_rows(self.sizes, self.whole)
        return full if self.whole else materialise(full, "recovery-full")

    def of_full_rows(self, df: DataFrame) -> DataFrame:
        if self.whole:
            return page_join(df, self.full_rows, ["row_no"], "left_semi")
        return df.join(self.full_rows, ["image_id", "row_no"], "left_semi")

    @cached_property
    def column_texts(self) -> DataFrame:
        texts = structure.normal_rows(self.rows, True) if self.whole else self.of_full_rows(self.rows)
        return structure.column_clusters(texts, self.whole)

    @cached_property
    def columns(self) -> DataFrame:
        return self.kept(structure.bounding_union(self.column_texts, "image_id", "col_no"), "recovery-columns")

    @cached_property
    def padded_columns(self) -> DataFrame:
        return structure.column_padding(self.columns, structure.page_edges(self.boxes), self.whole)

    @cached_property
    def extents(self) -> DataFrame:
        return self.kept(structure.row_extents(self.rows), "recovery-extents")

    @cached_property
    def hidden(self) -> DataFrame:
        return structure.hidden_rows(self.extents, self.whole)

    @cached_property
    def all_rows(self) -> DataFrame:
        return structure.add_rows(self.extents, self.hidden)

    @cached_property
    def trimmed(self) -> DataFrame:
        """All rows but the first two and the last one of the list."""
        chunk = {} if self.whole else {"inserted": F.col("inserted"), "block": F.floor(F.col("row_no") / 256)}
        listed = self.kept(self.all_rows, "recovery-all-rows")
        return structure.trim_rows(listed, ["image_id"], chunk, ["inserted", "row_no"], 2, 1)

    @cached_property
    def final_rows(self) -> DataFrame:
        trimmed = self.trimmed if self.whole else materialise(self.trimmed, "recovery-trimmed")
        return structure.row_heights(trimmed, self.whole)

    @cached_property
    def full_cells(self) -> DataFrame:
        """Cells of the rows that have every column."""
        return self.kept(structure.grid_cells(self.of_full_rows(self.extents), self.padded_columns), "recovery-full-cells")

    @cached_property
    def assigned(self) -> DataFrame:
        return self.kept(structure.assign_text_to_cell(self.boxes, self.full_cells, self.whole), "recovery-assigned")

    @cached_property
    def table(self) -> DataFrame:
        """Final rows x final columns with the texts of each cell, one line per text; blank cells have none."""
        rows = self.final_rows.withColumnRenamed("seq", "row_no")
        cells = self.kept(structure.grid_cells(rows, self.padded_columns), "recovery-cells")
        texts = structure.assign_text_to_cell(self.boxes, cells, self.whole)
        keys = ["row_no", "col_no"]
        texts = texts.select("image_id", *keys, "ann_id", "content")
        if self.whole:
            return page_join(cells, texts, keys, "left")
        return cells.join(texts, ["image_id", *keys], "left")
