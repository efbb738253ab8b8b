"""Value conversions and scalar functions of declared tables."""
