"""saltmesh: tidal-resource analytics as Spark DataFrame operators."""
