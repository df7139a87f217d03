"""Readers and writers: FASTA, alignments, structures, score files, result tables."""
