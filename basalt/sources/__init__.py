"""Readers that turn files of many layouts into tables with explicit schemas."""

from basalt.sources.sequences import fasta, fasta_checked, fasta_stats
from basalt.sources.tabular import delimited, json_records, resolve, tolerant_text

__all__ = ["delimited", "fasta", "fasta_checked", "fasta_stats", "json_records", "resolve", "tolerant_text"]
