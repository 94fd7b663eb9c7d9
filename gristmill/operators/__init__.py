"""Part of gristmill."""
