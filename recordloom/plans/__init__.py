"""Whole runs."""

from .curation import CurationInputs, CurationRun, collect_papers, master_of, master_version, run_curation, run_inbox
