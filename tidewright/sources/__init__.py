"""Sources and sinks: file listings, RIFF inventories, PCM windows, atomic JSON, WAV files."""
