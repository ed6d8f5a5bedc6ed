"""Column-level functions (all JVM-side built-ins except ``text.nfc``)."""
