"""Report plans: the eleven sheets, the batch report job and its outputs."""
