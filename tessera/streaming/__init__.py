"""Row-wise stages over streams."""
