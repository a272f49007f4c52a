"""Schemas of the tables this package reads and writes."""

from __future__ import annotations

SAT = (
    "project string, trf_id string, trf_head string, trf_l_ind bigint, trf_r_ind bigint, trf_period int, trf_n_copy double, trf_pmatch double, trf_pvar double, "
    "trf_entropy double, trf_consensus string, trf_array string, trf_array_gc double, trf_consensus_gc double, trf_array_length bigint, trf_joined int, trf_family string, trf_ref_annotation string"
)
GFF3 = "seqid string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes string"
FAI = "seqid string, length bigint, offset bigint, line_bases int, line_bytes int"
GAPS = "seqid string, start bigint, end bigint, kind string, length bigint, strand string"
KPROFILE = "seqid string, start bigint, end bigint, unique_kmers bigint"
MONOMERS = "array_id string, type string, length int, cut_sequence string"
FAMILIES = "seqid string, start bigint, end bigint, array_length bigint, period int, family string, consensus string, base_period int, source string"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]
