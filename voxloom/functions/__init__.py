"""voxloom.functions"""
