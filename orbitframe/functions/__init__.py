"""Part of orbitframe."""
