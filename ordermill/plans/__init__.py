"""The layered model (staging -> intermediate -> marts -> reports) and the
batch / replay jobs, each a function of DataFrames."""
