"""Training-data operators: licence and secret scans, language-model quality,
near-duplicate detection, exact search, packing, BPE, HTML extraction and line
de-duplication. Nothing outside this subpackage imports it."""
