"""Row-group skipping reports, and statistics of declared tables."""
