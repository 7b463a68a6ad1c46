"""Generic DataFrame operators; none of them knows a clinical code."""
