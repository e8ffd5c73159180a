"""Row-level and set operators composed from DataFrame operations: cleaning,
validation rules, global numbering, histograms, sampling, checked joins."""
