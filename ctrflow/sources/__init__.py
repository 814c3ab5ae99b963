"""Tables, files and requests the library reads and writes."""
